"""Column-level helpers (no actions, no shuffles)."""

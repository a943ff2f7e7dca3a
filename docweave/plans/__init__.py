"""Whole jobs (pipelines of operators) and the registry of checked queries."""

"""Incremental enrichment as a Structured Streaming job."""

"""Incremental (Structured Streaming) ingest into Bronze."""

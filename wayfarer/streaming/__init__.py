"""Incremental (Structured Streaming) ingestion of feed folders."""

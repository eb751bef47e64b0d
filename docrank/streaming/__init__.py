"""Structured Streaming ingestion into the index."""

"""Structured Streaming variants of the daily close and the upsert load."""

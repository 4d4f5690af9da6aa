"""Structured Streaming form of the incremental upsert."""

"""Incremental upserts with Structured Streaming."""

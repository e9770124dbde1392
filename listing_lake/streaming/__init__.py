"""Structured Streaming versions of the batch steps."""

"""Structured Streaming operators; each has a batch twin on the same columns."""

"""Structured Streaming twins of the incremental jobs."""

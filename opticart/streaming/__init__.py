"""Structured Streaming forms of the incremental products."""

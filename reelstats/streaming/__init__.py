"""Incremental versions of the popularity statistics (Structured Streaming)."""

"""Incremental text intake on Structured Streaming."""

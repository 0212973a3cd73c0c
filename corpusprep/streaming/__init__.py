"""Structured Streaming variants of the row-wise preparation steps."""

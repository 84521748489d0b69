"""Structured Streaming queries over the batch operators."""

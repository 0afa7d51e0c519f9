"""Structured Streaming forms of two operators."""

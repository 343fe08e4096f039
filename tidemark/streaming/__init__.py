"""Structured Streaming paths: stream-mode sync, strict append, interval rates."""

"""Structured Streaming forms: stream runners and stateful processors."""

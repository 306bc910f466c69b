"""Structured Streaming forms of encoding and counting."""

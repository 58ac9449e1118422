"""Structured Streaming plans."""

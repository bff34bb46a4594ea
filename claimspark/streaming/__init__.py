"""Structured Streaming jobs built from the same row-level operators."""

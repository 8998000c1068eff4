"""Structured Streaming extension (windowed counts and keyed corrections)."""

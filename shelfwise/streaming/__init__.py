"""Structured Streaming jobs."""

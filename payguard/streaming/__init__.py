"""Structured Streaming jobs for Bronze and Silver."""

"""Structured Streaming jobs; all end by themselves with ``availableNow``."""

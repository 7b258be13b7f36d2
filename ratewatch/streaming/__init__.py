"""Structured Streaming jobs, their settings and sinks."""

"""Structured Streaming versions of the monitor refresh."""

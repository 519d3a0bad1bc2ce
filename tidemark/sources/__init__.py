"""Scans, snapshots, change feeds and sinks."""

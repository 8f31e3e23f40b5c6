"""Scans, fixture views and sinks."""

"""Scans, sinks and message decoding."""

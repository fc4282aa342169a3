"""Scans, message decoding and sinks."""

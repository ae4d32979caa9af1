"""Scans over landed files and the sinks that write them back."""

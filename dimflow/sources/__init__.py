"""Scans, sinks and staged tables."""

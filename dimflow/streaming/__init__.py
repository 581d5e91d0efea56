"""Incremental processing: stored high-water marks and file streams."""

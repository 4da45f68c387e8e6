"""Incremental streams."""

"""Snapshot analytics on PySpark."""

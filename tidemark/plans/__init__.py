"""Marts, gates, run state and the query catalogue."""

"""Incremental forms of the run analytics."""

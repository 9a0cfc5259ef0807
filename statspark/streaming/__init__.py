"""Incremental runs over landing folders."""

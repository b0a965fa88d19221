"""Incremental runs over landing files, on file-source streams."""

"""Incremental landing as a file stream."""

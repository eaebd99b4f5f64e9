"""Incremental runs over newly landed files."""

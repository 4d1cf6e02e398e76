"""Writes. Every one can be repeated with the same run without changing the result."""

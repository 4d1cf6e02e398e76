"""Streaming form of the bronze load."""

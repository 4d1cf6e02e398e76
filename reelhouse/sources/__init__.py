"""Scans: landed JSON, layer tables, response pages, high-water marks."""

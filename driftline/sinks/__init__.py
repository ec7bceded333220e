"""Exact-named files, archives and small tables."""

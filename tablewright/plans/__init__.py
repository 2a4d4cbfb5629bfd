"""Catalog, seeds and job matrices."""

"""Harvest of pages as they land."""

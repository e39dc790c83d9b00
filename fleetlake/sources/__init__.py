"""Readers: CSV (bronze input), catalog tables, file inventory, fixture views."""

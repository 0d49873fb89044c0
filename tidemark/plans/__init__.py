"""Queries over the stored tables, and the registry of all of them."""

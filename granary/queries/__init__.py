"""Queries over the driver tables, by operator family."""

"""Granary: a DataFrame-first analytics engine."""

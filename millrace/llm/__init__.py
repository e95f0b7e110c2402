"""Operators for large-scale training text. Optional: nothing outside this package imports it."""

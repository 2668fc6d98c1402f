"""Operators for preparing training text; each has its own module, queries are in `queries`."""

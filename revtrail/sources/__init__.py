"""Schemas, table files and test tables."""

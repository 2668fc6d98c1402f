"""Whole answers put together from the operators."""

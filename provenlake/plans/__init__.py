"""Whole builds composed from the operators."""

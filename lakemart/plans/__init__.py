"""Marts and reports built from the cleaned tables."""

"""Layered commerce analytics as DataFrame-in, DataFrame-out Spark operators."""

"""Scalar functions as Column expressions: text, timeline, geometry, rounding."""

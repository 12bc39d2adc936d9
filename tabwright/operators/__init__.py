"""Operators: each is a fit (few aggregates) and a transform (a projection)."""

"""Operators for building training data. Nothing outside this package imports it."""

"""Scalar rules: types, log positions, schema changes."""

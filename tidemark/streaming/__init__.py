"""Continuous merge."""

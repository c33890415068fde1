"""Quads that arrive over time."""

"""Operators on DataFrames; each takes frames and returns a frame."""

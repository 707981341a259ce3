"""Relational operators: each takes a DataFrame and parameters and returns a DataFrame."""

"""Reusable relational operators; each takes and returns DataFrames."""

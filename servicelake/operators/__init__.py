"""Relational operators over lazy DataFrames."""

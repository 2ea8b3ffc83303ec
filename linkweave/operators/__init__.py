"""Relational operators: from DataFrames to DataFrames, without actions."""

"""Lazy operators: DataFrames in, DataFrames out, no actions."""

"""Batch operators: DataFrames in, DataFrames out; nothing runs until the caller acts."""

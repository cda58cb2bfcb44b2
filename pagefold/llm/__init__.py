"""Operators of a training-data pipeline, on plain Spark DataFrames."""

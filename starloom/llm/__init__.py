"""Operators for the preparation of training text, each on Spark DataFrames."""

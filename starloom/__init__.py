"""Warehouse loading and data-quality operators on Spark DataFrames."""

from starloom.context import LoadContext

__all__ = ["LoadContext"]

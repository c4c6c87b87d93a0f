"""Retail analytics operators for Spark: DataFrames in, one lazy DataFrame out."""

__version__ = "0.1.0"

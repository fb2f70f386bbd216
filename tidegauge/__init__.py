"""Reusable data jobs on Spark DataFrames for leakage-safe analytical tables."""

__version__ = "0.1.0"

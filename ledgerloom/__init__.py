"""Batch analytics on Spark DataFrames: lookups, history tables, JSON/XML, quality, finance."""

__version__ = "0.1.0"

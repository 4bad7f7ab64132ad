"""Jangbu: a ledger engine for procurement-style data on Spark DataFrames."""

__version__ = "0.1.0"

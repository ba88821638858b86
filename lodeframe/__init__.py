"""Lodeframe: faceted predicates, session state and corpus quality on Spark DataFrames."""

__version__ = "0.1.0"

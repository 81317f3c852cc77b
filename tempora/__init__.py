"""Timed intervals, ordered text and keyed results as Spark DataFrames."""

"""Interval, sequence, join, aggregate, vector and keyed-result operators."""

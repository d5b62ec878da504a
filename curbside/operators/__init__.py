"""Operators: functions from DataFrames to a DataFrame. None of them caches or collects rows."""

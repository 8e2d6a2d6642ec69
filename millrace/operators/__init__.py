"""Operators: functions that take and return DataFrames and never collect."""

"""Operators: functions from DataFrames to a DataFrame. They start no job unless their docstring says so."""

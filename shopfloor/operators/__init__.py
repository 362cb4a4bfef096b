"""Operators: each takes DataFrames and gives one."""

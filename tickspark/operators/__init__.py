"""Operators: functions from DataFrames to one lazy DataFrame."""

"""Data jobs: functions from DataFrames to DataFrames, keys and measures given by name."""

"""Linking two event tables by key and time, on Spark DataFrames."""

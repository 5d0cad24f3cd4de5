"""Behavioural time-series analytics on Spark DataFrames."""

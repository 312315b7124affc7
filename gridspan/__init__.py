"""Hourly grid-data analytics on Spark DataFrames."""

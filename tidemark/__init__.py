"""Batch web-traffic analytics on Spark DataFrames."""

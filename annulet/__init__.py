"""Circular-DNA analytics on Spark DataFrames."""

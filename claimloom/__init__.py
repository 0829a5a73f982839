"""Pharmacy-claims batch analytics on Spark DataFrames."""

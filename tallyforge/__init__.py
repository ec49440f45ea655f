"""Order analytics on Spark DataFrames."""

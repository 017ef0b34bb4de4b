"""Episode-quality analytics on Spark DataFrames."""

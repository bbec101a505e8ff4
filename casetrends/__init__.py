"""Case-count analytics on Spark DataFrames."""

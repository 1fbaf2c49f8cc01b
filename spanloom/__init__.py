"""Timeline analytics on Spark DataFrames."""

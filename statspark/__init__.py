"""Player-performance analytics on Spark DataFrames."""

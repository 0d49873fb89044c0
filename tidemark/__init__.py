"""Trade-tick analytics on Spark DataFrames and Structured Streaming."""

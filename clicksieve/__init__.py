"""Click-fraud analytics on Spark DataFrames and Structured Streaming."""

"""Hotel-booking analytics on Spark DataFrames, Structured Streaming and MLlib."""

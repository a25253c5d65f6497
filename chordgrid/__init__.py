"""Beat-grid and event-sequence analytics on Spark DataFrames."""

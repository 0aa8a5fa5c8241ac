"""lexweave: legislative-text operators on Spark DataFrames."""

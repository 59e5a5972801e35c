"""Text clustering of reviews on Spark DataFrames."""

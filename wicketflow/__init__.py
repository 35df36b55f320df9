"""Ball-by-ball match analytics on Spark DataFrames."""

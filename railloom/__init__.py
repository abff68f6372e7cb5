"""Rail network analytics on Spark DataFrames."""

"""Hospital warehouse jobs on Spark DataFrames."""

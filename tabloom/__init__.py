"""Table operators for catalogue-style data on Spark DataFrames."""

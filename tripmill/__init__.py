"""tripmill: batch processing of trip records on Spark DataFrames."""

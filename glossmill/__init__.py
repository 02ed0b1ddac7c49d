"""glossmill: corpus preparation, sequence analytics and evaluation on Spark DataFrames."""

"""Fleet-health analytics on Spark: DataFrames in, DataFrames out."""

"""Analytics operators for PySpark: DataFrames in, DataFrames out."""

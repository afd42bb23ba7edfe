"""Data preparation, statistics and learning operators on Spark DataFrames."""

"""Case and ticket redressal analytics on Spark DataFrames."""

"""Point-in-time market data on Spark DataFrames."""

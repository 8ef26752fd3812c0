"""Building and maintaining a small star schema from raw JSON logs, on Spark DataFrames."""

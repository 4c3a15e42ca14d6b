"""Analytics operators: each takes canonical DataFrames and returns a lazy DataFrame."""

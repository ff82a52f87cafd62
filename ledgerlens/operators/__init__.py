"""DataFrame operators: each takes DataFrames and column names, returns a DataFrame."""

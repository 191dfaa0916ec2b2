"""DataFrame -> DataFrame operators. Each takes whole DataFrames and column names as arguments."""

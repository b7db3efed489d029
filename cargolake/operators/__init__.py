"""DataFrame operators. Each takes and returns DataFrames and, unless it says so, runs no job."""

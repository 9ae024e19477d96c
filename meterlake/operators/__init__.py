"""Layer transformations: pure functions from DataFrames to DataFrames."""

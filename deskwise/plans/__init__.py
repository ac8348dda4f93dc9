"""Models, reports and checks, as functions from DataFrames to DataFrames."""

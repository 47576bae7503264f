"""Statement files and price bars read into typed DataFrames."""

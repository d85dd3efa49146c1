"""Medallion and change-data operators for Spark: every operator maps DataFrames to DataFrames."""

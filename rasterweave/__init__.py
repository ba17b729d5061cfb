"""Raster and vector analytics on Spark DataFrames."""

"""Customer analytics for online retail on Spark DataFrames."""

"""Record linkage and incremental delivery on Spark DataFrames."""

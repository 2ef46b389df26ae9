"""Document-structure and chunk-quality analytics on Spark DataFrames."""

"""Dataset-quality and model-evaluation analytics on Spark DataFrames."""

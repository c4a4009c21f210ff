"""Surface-water network and drainage-area analytics on Spark DataFrames."""

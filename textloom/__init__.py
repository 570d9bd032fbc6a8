"""textloom: corpus analytics expressed as Spark DataFrames."""

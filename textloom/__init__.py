"""textloom: corpus curation on Spark DataFrames."""

"""rollcall: registry synchronisation and record linkage on Spark DataFrames."""

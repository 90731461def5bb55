"""siltstone: provenance-preserving dataset building on Spark DataFrames."""

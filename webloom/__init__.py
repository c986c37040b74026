"""webloom: crawled web records -> search-ready index documents, on Spark DataFrames."""

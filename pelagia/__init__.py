"""Geo-temporal enrichment, training sets and presence scoring on Spark DataFrames."""

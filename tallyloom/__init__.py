"""Retail data-quality and enrichment operators for Spark DataFrames."""

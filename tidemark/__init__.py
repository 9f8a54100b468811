"""Tidemark: a change-data lakehouse engine on Spark DataFrames."""

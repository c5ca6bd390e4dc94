"""Grounded table analytics and text data processing on Spark DataFrames."""

"""Cohort-matrix analytics on Spark: long measurement tables in, DataFrames out."""

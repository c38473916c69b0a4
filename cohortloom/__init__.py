"""Cohort queries on Spark DataFrames."""

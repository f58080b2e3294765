"""Cohort, event-window and outcome analytics on Spark DataFrames."""

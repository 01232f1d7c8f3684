"""Batch jobs for a book catalogue and its monthly sales, as Spark DataFrames."""

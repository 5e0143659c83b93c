"""Matching, classifying and reporting on large record tables with Spark DataFrames."""

"""Tabular regression workbench on Spark DataFrames."""

"""Regression models: fitted on a DataFrame, applied as column expressions."""

"""Folds, scores, searches and comparisons."""

"""Operators for training-data pipelines: one module each, on DataFrames of texts."""

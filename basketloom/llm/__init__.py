"""Operators for training-data pipelines: DataFrame in, DataFrame out."""

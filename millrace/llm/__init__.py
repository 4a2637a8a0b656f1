"""Operators of a training-data pipeline: text and vector columns in, DataFrames out."""

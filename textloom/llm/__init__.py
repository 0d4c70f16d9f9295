"""Operators of a training-data pipeline, each a DataFrame-in, DataFrame-out job."""

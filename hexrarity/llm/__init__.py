"""Operators of a training-data pipeline; each module holds one, on DataFrames."""

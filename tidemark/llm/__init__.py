"""Operators of a training-data pipeline: quality, duplicates, tokens, packing."""

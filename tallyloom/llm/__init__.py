"""Operators of a training-data pipeline: archives, sharding, search, duplicates, packing, models on text."""

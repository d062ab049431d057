"""Operators for training-data pipelines: identification, filtering, deduplication,
mixing, scoring and output. Nothing else in the library imports this package."""

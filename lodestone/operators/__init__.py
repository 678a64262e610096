"""Operators over DataFrames: registries, integrity, datasets, metrics."""

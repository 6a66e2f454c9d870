"""Operators for training-data pipelines: cleaning, near duplicates, search, scoring, mixing and packing."""

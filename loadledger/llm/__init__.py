"""Operators for training-data pipelines: packing, scoring, near copies, scans and search."""

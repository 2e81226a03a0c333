"""Operators for training-data corpora; their queries are in `queries`."""

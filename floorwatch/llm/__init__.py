"""Operators for training data: cleaning, duplicates, contamination, tokens, packing."""

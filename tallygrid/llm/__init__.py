"""Operators for training data: scoring, filtering, deduplication, mixing. Nothing else in the library imports them."""

"""Operators for training data: deduplication, scoring, extraction, encoding and mixing."""

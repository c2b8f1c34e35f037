"""Operators for preparing training data: filtering, deduplication, mixing, scoring, tokenising and search."""

"""Operators for large-scale training data: cleaning, scoring, deduplication, sharding and tokenizing."""

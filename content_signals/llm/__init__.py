"""Operators for building training text: scoring, cleaning, deduplication, tokenization, search."""

"""Operators for preparing training text: deduplication, filtering, mixing, tokenisation and scoring."""

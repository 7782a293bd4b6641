"""Operators for training corpora: near-duplicates, contamination, filters, mixing, extraction and captures."""

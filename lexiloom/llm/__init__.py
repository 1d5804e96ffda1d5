"""Operators for large text corpora: filtering, deduplication, mixing and packing."""

"""Operators for large training corpora: filters, deduplication, sharding and packing."""

"""Operators for preparing training text: encoding, scoring, filtering, deduplication, sharding and search."""

"""Operators for preparing training text: scoring, filters, deduplication, mixing, sharding, archives."""

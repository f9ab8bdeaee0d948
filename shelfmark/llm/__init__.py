"""Operators for preparing training text: filtering, deduplication, formatting, packing, sharding."""

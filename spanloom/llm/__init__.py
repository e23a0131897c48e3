"""Operators for preparing training text: filtering, deduplication, mixing and sharding."""

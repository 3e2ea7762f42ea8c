"""Operators and a pipeline for preparing training text: dedup, packing, tokenising, filtering, sharding."""

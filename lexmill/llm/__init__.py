"""Operators for preparing training data: deduplication, packing, mixing, scrubbing, filtering, formatting."""

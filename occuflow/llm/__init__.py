"""Training-data operators (text mixing, deduplication, filtering, packing, scoring)."""

"""Training-data operators: deduplication, quality, mixing, packing, extraction, archives."""

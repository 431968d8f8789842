"""Training-data operators: deduplication, quality, mixing, packing, search, URL filters and token files."""

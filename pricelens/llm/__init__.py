"""Training-data operators: deduplication, filters, scores, search, mixing and packing."""

"""Training-data operators: token counts, near-duplicates, filters, mixing, packing."""

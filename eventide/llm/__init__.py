"""Training-data operators: dedup, extraction, mixing, identification, packing."""

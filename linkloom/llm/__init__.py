"""Training-data operators: deduplication, extraction, filtering, mixing and packing of text."""

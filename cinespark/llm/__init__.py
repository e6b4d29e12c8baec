"""Training-data operators: extraction, cleaning, deduplication, scoring and packing of text at scale."""

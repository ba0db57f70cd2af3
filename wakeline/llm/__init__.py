"""Training-data operators: cleaning, near-duplicates, mixing and packing of document tables."""

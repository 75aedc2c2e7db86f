"""Training-data operators: packing, deduplication, tokens, archives, toxicity and fingerprints."""

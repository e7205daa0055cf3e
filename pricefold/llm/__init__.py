"""Training-data operators: scoring, archives, deduplication, screening, tokens."""

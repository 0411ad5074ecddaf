"""Training-data operators: near duplicates, filters, scoring, encoding, sharding."""

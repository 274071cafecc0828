"""Training-data operators: tokenising, sharding, archives, filtering and near-duplicate search."""

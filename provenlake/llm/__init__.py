"""Training-data operators: packing, language, personal data, near duplicates, shards, tokens, quality."""

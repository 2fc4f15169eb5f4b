"""Training-data operators: scoring, packing, extraction, search, tokens, language, quality and duplicates."""

"""Training-data operators: secrets, personal data, deduplication, quality, packing, language models, mixing."""

"""Training-data operators: de-duplication, encoding, quality, language models."""

"""Operators for large training corpora: licences, tokens, mixing, quality, duplicates, archives and vector search."""

"""Operators for building training corpora: deduplication, decontamination, search, tokens, archives, packing."""

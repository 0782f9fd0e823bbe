"""Operators on text corpora: language, toxicity, fingerprints, quality, duplicates, leaks, archives, token files."""

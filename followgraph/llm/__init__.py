"""Operators for training-data pipelines: near-duplicates, tokens, vectors, leaks, quality,
secrets, main text, licences, repeated passages and language-model scores."""

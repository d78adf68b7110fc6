"""Operators of a training-data pipeline: texts, tokens, near duplicates, vectors, mixtures."""

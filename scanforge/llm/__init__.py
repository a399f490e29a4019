"""Operators of a training-data pipeline: quality, near-duplicates, private data, secrets, languages, licences, mixing, tokens."""

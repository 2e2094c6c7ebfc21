"""Operators of a training-data pipeline: sharding, search, language, secrets, tokens, mixing, duplicates, licences, quality."""

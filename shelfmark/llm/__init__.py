"""Operators of a training-data pipeline: tokens, fingerprints, duplicates, mixing, shards."""

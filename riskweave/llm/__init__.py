"""Operators for training-data pipelines: tokens, fingerprints, quality, dedup, languages, secrets, personal data."""

"""Operators of a training-data pipeline: filters, duplicates, decontamination, personal data, tokens, packing, shards."""

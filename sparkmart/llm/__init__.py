"""Operators of a training-data pipeline: near duplicates, packing, tokens, archives, filters, licences and quality."""

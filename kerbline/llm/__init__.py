"""Operators of a training-data pipeline: WARC, text quality, duplicates, tokens, packing."""

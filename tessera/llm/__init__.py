"""Operators of a training-data pipeline: tokens, packing, mixing, dedup, media, quality, privacy, URLs, archives."""

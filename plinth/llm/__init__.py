"""Operators of a training-data pipeline: extraction, packing, deduplication, scoring, encoding and archives."""

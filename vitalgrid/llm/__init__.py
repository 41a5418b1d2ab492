"""Operators of a training-data pipeline: quality, text extraction, duplicates, tokens, mixing."""

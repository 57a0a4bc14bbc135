"""Operators for training-data pipelines: text, tokens, duplicates, quality, mixing, chat."""

"""Operators for training-data pipelines on text, records and numbers; nothing outside imports this package."""

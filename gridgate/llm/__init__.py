"""Operators for training data: counting, scanning, deduplicating, scoring, cleaning and packing of documents."""

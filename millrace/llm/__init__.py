"""Operators for training text: packing, extraction, near-duplicates, filters, models.

Each module holds one operator with its own interface; ``queries`` registers one query for each.
Nothing outside this package imports it.
"""

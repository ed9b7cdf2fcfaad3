"""Operators for preparing training text: deduplication, filters, search, tokenising, packing, archives.

Nothing else in the library imports this package.
"""

"""Operators for preparing training data: URL filters, near-duplicates, tokens, personal data, quality, packing.

Nothing else in the library imports this subpackage.
"""

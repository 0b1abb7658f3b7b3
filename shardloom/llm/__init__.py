"""Operators of a training-data pipeline: deduplication, mixing, quality, URL
and secret filters, chat formatting, tokenisation, archives and toxicity.

Nothing else in the library imports this subpackage; it can be removed whole.
"""

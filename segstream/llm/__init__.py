"""Operators of a training-data pipeline: filters, near-duplicates, language
models, tokenization, packing, search and sharding.

One module per operator; ``queries`` registers them over the driver's tables.
Nothing outside this package imports it.
"""

"""Operators for building training corpora: deduplication, token counting,
packing, quality rules, licence scans, source mixing and token files.

One module per operator, ``common`` for what they share, ``queries`` for the
registered queries. Nothing outside this folder imports it.
"""

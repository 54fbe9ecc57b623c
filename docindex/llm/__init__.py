"""Operators for preparing training text: joins of similar documents,
deduplication, web archives, tokens, decontamination, search, sharding,
language and quality models, and page extraction.

Nothing outside this subpackage imports it.
"""

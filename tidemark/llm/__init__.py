"""Training-data operators: deduplication, filtering, search, tokenisation and packing.

Nothing outside this subpackage imports it; its queries live in :mod:`tidemark.llm.queries`.
"""

"""Operators of a training-data pipeline: dedup, sharding, search, tokens, filters, mixing.

Nothing outside this subpackage imports it. Queries and their SQL are in
``bandwise.llm.queries``.
"""

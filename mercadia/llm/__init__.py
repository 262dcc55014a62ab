"""Operators for preparing training data: search, privacy, de-duplication,
packing, tokenizing, chat rendering, similarity joins, sharding and quality."""

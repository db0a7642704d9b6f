"""The operators applied to the given tables."""

"""Registered queries: each applies library operators to the given tables."""

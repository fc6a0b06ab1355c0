"""Registered queries: each operator on the given tables, with the same result in SQL."""

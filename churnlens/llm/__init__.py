"""Operators for training-data pipelines over the `documents`-like tables.

Nothing outside this package imports it; `queries.py` holds the registered
queries and their SQL.
"""

"""Operators for preparing training text: rules, filters, deduplication, formatting, packing.

Nothing outside this subpackage imports it. Each module holds one operator with
its own interface; `queries.py` registers the thin queries over the test tables
and `oracles.py` their SQL.
"""

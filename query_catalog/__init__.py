"""Registered queries: every operator run over the given tables, with the same result in SQL.

Each module offers ``QUERIES`` (name to a function of session and data directory) and ``SQL``
(name to a DuckDB statement over views of the same tables).
"""

"""Operators for preparing large text corpora.

Nothing outside this folder imports it.  ``queries.py`` and ``oracles.py`` hold
the registered queries and their SQL.
"""

"""Registered queries, their inputs derived from the given tables, and their SQL."""

from __future__ import annotations

from tallyshelf.registry import catalogue_queries, ledger_queries, phone_queries, text_queries

_GROUPS = (catalogue_queries, phone_queries, ledger_queries, text_queries)

QUERIES = {name: fn for group in _GROUPS for name, fn in group.QUERIES.items()}
SQL = {name: sql for group in _GROUPS for name, sql in group.SQL.items()}

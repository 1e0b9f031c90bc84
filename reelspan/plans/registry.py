"""Registered queries and their SQL."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its name, with the SQL that gives the same rows."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


from reelspan.plans import frames, requests, texts  # noqa: E402, F401

"""Where the queries of this subpackage are registered."""

from __future__ import annotations

from devicepulse.llm.common import Query

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql.strip()
        return fn

    return register

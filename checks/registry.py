"""Registration of queries with the SQL they are compared to."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register

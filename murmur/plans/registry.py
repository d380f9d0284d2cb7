"""Named queries over the provided tables, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from murmur.sources.adapters import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function name; `sql` may name the adapter views."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            SQL[key] = with_views(sql)
        return function

    return register


def with_views(sql: str) -> str:
    used = [f"{name} as ({text})" for name, text in VIEWS.items() if name in sql]
    body = sql.strip()
    if not used:
        return body
    if body.startswith("with "):
        return "with " + ", ".join(used) + ", " + body[len("with "):]
    return "with " + ", ".join(used) + " " + body


def load_all() -> None:
    from murmur.plans import (  # noqa: F401
        aggregates,
        filters,
        joins,
        ordered,
        retrieval,
        scalars,
        scans,
        streams,
    )

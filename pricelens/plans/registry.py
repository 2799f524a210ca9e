"""Registry of the checked queries: a Spark callable and, where the result can
be stated in SQL, the text another engine runs on the same tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql.strip()


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return add


def expand(sql: str) -> str:
    """Prefix a query with the common table expressions it refers to."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    ctes = ",\n".join(f"{name} AS (\n{VIEWS[name]}\n)" for name in ordered)
    if re.match(r"(?is)^\s*with\s", sql):
        return f"WITH {ctes},\n" + re.sub(r"(?is)^\s*with\s", "", sql, count=1)
    return f"WITH {ctes}\n{sql}"

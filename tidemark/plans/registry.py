"""Named queries, each with the SQL a second engine can run to check it."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import views
from tidemark.session import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = expand(oracle)
        return run

    return wrap


def expand(sql: str) -> str:
    """Prepend the definitions of every view the text mentions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for view in views.SQL:
            if re.search(rf"\b{view}\b", text) and view not in needed:
                visit(views.SQL[view])
                needed.append(view)

    visit(sql)
    if not needed:
        return sql
    heads = ",\n".join(f"{v} AS ({views.SQL[v]})" for v in needed)
    body = sql.strip()
    if start := re.match(r"(?i)with(\s+recursive)?\b", body):
        return f"{start.group(0)} {heads},\n{body[start.end():].lstrip()}"
    return f"WITH {heads}\n{body}"

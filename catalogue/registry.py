"""Query registration: a Spark callable and, where SQL can say the same, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, oracle: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = query
    if oracle is not None:
        ORACLES[name] = oracle


def num(expr: str, kind: str = "INTEGER") -> str:
    """DuckDB: whole number or NULL; empty text is 0."""
    return (
        f"CASE WHEN trim({expr}) = '' THEN 0 WHEN regexp_full_match(trim({expr}), '[+-]?[0-9]+') "
        f"THEN TRY_CAST({expr} AS {kind}) END"
    )


def big(expr: str) -> str:
    return num(expr, "BIGINT")

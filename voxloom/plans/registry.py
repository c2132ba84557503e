"""Named queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name; sql: the same rows on the same tables."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def sql_draw(seed: int, *key: str) -> str:
    """What ``operators.sampling.draw`` computes, in SQL."""
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(key)}, {seed})), 1, 15))::BIGINT"

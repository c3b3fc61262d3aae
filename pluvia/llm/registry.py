"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def checked_by(sql: str) -> Callable[[Query], Query]:
    def also(query: Query) -> Query:
        ORACLES[query.__name__] = sql
        return register(query)

    return also

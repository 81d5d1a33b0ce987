"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and, where
SQL can express the operator, an independent DuckDB SQL text over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise KeyError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco

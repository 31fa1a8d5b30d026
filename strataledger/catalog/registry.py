"""Registered queries: a Spark callable each and, where SQL can say it, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataledger.catalog.context import Layers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(layers) -> DataFrame`` under a name."""

    def register(build: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Layers(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return build

    return register

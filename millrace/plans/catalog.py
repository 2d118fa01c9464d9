"""The registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

Query = Callable[[SparkSession, str], DataFrame]


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        label = name or fn.__name__
        if label in QUERIES:
            raise ValueError(f"{label} is registered twice")
        QUERIES[label] = fn
        if sql is not None:
            ORACLES[label] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

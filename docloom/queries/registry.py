"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from docloom.session import ship_package, spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, ints: str = "") -> Callable[[Query], Query]:
    """Register a query; ``ints`` lists the columns that are INT (SQL counts in BIGINT)."""

    def add(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            narrow = ", ".join(f"{c}::INTEGER AS {c}" for c in ints.split())
            ORACLES[name] = f"SELECT * REPLACE ({narrow}) FROM ({sql})" if ints else sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide(spark: SparkSession, sf_dir: str, name: str, key: str, *cols: str) -> DataFrame:
    """Some columns of a table for heavy work per row: redistributed if the scan has too few splits."""
    return spread(table(spark, sf_dir, name).select(key, *cols), key)

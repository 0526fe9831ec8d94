"""Registry of this subpackage's queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder of tables), with its SQL where SQL can express it."""
    def add(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return build(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")

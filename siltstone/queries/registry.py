"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.session import ship_package
from siltstone.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text and decimals as doubles, so that two engines' outputs compare."""
    def shown(f: T.StructField):
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.col(f"`{f.name}`").cast("string").alias(f.name)
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return F.col(f"`{f.name}`").cast("double").alias(f.name)
        return F.col(f"`{f.name}`")

    return df.select([shown(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register a function of the tables under a name, with its SQL where SQL can express it."""
    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return plain(build(Tables(spark, folder)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})

"""Joins and numbering that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key with more than this share of all rows is joined by broadcast; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 2000


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def boxed(docs: DataFrame, **beside: Column) -> DataFrame:
    """All columns as one, ``_row``, beside columns of the operator's own: no name of the caller's can clash with them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[c.alias(name) for name, c in beside.items()])


def unboxed(rows: DataFrame, columns: Sequence[str], **changed: Column) -> DataFrame:
    """The columns of boxed rows again, some of them changed."""
    return rows.select(*[changed.get(c, F.col("_row").getField(c)).alias(c) for c in columns])


def join_facts(rows: DataFrame, facts: DataFrame, keys: Sequence[str], weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one row of ``facts`` per key.

    ``weight`` is a column of ``facts`` with the number of rows that have the key,
    out of ``total``. Keys above HOT_SHARE are broadcast, which is at most
    1 / HOT_SHARE rows whatever the size of the input; the others are shuffled,
    and none of them can fill a partition. The weight is not in the result.
    """
    limit = max(1, int(total * HOT_SHARE))
    keys = list(keys)
    hot = F.broadcast(facts.where(F.col(weight) > limit).drop(weight))
    cold = facts.where(F.col(weight) <= limit).drop(weight)
    warm = rows.join(hot, keys, "inner")
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, "inner")
    return warm.unionByName(rest)


def numbered(rows: DataFrame, group: str, bucket: str, order: Sequence[Column], name: str) -> DataFrame:
    """Numbers rows from 0 within ``group``, by ``bucket`` and then ``order``.

    Rows are sorted within (group, bucket) only; the offsets of buckets are a
    running total over one row per group and bucket, so neither a large group
    nor the whole table is ever sorted in one task. The caller bounds the
    number of buckets and groups, and with it the broadcast table of offsets.
    """
    inside = Window.partitionBy(group, bucket)
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(group, bucket).agg(F.count(F.lit(1)).alias("_n"))
        .select(group, bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        rows.withColumn("_place", F.row_number().over(inside.orderBy(*order)))
        .join(F.broadcast(offsets), [group, bucket])
        .withColumn(name, F.col("_before") + F.col("_place") - 1)
        .drop("_place", "_before")
    )

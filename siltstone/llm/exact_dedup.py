"""Exact de-duplication with a heavy-hitter split.

A Misra-Gries summary finds the digests that could be frequent. Their exact
counts and winners are computed with map-side aggregation, and the digests that
really are frequent, at most 1 / SUPPORT of them, are broadcast: their copies
are resolved, or removed, where they are read. All other digests are shuffled;
none of them has more than a SUPPORT share of the rows.

Defined results: null text counts as empty; rows with a null doc_id lose against
any other; of rows that agree in text and doc_id one stays; an empty table gives
an empty result; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.keys import boxed, text_of, unboxed
from siltstone.session import settle

# Share of all rows from which a digest is handled by broadcast.
SUPPORT = 1 / 1000
# Counters of a Misra-Gries summary; it misses no digest above a 1 / (2 * SUPPORT) part of its rows.
COUNTERS = 16_384
# Summaries merged separately, so that no task merges those of all partitions.
SUMMARIES = 32


def frequent_candidates(digests: DataFrame) -> DataFrame:
    """A superset of the digests with more than a SUPPORT share of the rows.

    A digest that frequent overall is that frequent in some set of partitions.
    ``approx_top_k`` keeps the counters of a Misra-Gries summary; what it returns
    is only a list of candidates, at most SUMMARIES * 2 / SUPPORT digests.
    """
    top = int(2 / SUPPORT)
    return (
        digests.groupBy((F.spark_partition_id() % SUMMARIES).alias("_part"))
        .agg(F.expr(f"approx_top_k(text_sha256, {top}, {COUNTERS})").alias("_top"))
        .select(F.explode("_top.item").alias("text_sha256"))
        .distinct()
    )


def frequent_winners(digests: DataFrame, total: int) -> DataFrame:
    """The frequent digests, each with its exact number of rows and its winning doc_id."""
    return (
        digests.join(F.broadcast(frequent_candidates(digests)), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where(F.col("group_size") > max(1, int(total * SUPPORT)))
    )


def digest_table(docs: DataFrame) -> DataFrame:
    """(doc_id, text_sha256, row), written once so that long texts are read and hashed once."""
    return settle(docs.select(
        "doc_id", F.sha2(text_of(), 256).alias("text_sha256"), F.monotonically_increasing_id().alias("row"),
    ))


def copy_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = digest_table(docs)
    winners = settle(frequent_winners(digests, digests.count()))
    hot = digests.join(F.broadcast(winners), "text_sha256")
    first_row = (
        hot.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("text_sha256").agg(F.min("row").alias("_first"))
    )
    hot = hot.join(F.broadcast(first_row), "text_sha256").withColumn("kept", F.col("row") == F.col("_first"))
    group = Window.partitionBy("text_sha256")
    best_first = group.orderBy(F.col("doc_id").desc_nulls_last(), "row")
    rest = (
        digests.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
        .withColumns({
            "keep_id": F.first("doc_id").over(best_first),
            "group_size": F.count(F.lit(1)).over(group),
            "kept": F.row_number().over(best_first) == 1,
        })
    )
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return hot.select(*columns).unionByName(rest.select(*columns))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Copies of frequent texts are removed where they are read; the rest is one
    shuffle, before which every task already keeps one row per text.
    """
    digests = digest_table(docs)
    winners = settle(frequent_winners(digests, digests.count())).select(
        F.col("text_sha256").alias("_digest"), F.col("keep_id").alias("_keep"), F.lit(True).alias("_hot"),
    )
    best_first = Window.partitionBy("_digest").orderBy(F.col("_id").desc_nulls_last())
    stay = (
        boxed(docs, _id=F.col("doc_id"), _digest=F.sha2(text_of(), 256))
        .join(F.broadcast(winners), "_digest", "left")
        .where(F.col("_hot").isNull() | F.col("_id").eqNullSafe(F.col("_keep")))
        .withColumn("_place", F.row_number().over(best_first))
        .where(F.col("_place") == 1)
    )
    return unboxed(stay, docs.columns)

"""Balanced label propagation: linked documents gather in shards whose row counts stay equal.

Documents with the same key are linked to each other. Every document starts in
the shard its id hashes to. In each round the linked documents that would have
more neighbours in another shard ask to move to the shard where most of their
neighbours are; a shard admits as many as its quota has room for, those with
the most neighbours first. Documents without links have no wish and fill what
is left. A round works on one row per key and starting shard, so copies of a
text that a third of all rows share are as many rows as there are shards.

Defined results: row counts of any two shards differ by one at most, whatever
the links; null text counts as empty; rows with equal ids are separate rows; an
empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.keys import join_facts, numbered, text_of
from siltstone.session import settle

ROUNDS = 5
# Buckets for numbering rows: by key, and within it by document.
KEY_BUCKETS = DOC_BUCKETS = 64
# Part of a shard's remaining room that a partly admitted class of movers may fill.
FILL = 0.95
DRAWS = 1 << 20


def quotas(total: int, shards: int) -> list[int]:
    """Rows per shard, as even as they can be."""
    return [total // shards + (s < total % shards) for s in range(shards)]


def _blocks(rows: DataFrame) -> DataFrame:
    """(key, home, shard, n) of the linked documents: those of one key that start in one shard."""
    blocks = rows.groupBy("key", "home").agg(F.count(F.lit(1)).alias("n"))
    linked = blocks.groupBy("key").agg(F.sum("n").alias("_all")).where(F.col("_all") > 1).select("key")
    return blocks.join(linked, "key").withColumn("shard", F.col("home"))


def _wishes(blocks: DataFrame) -> DataFrame:
    """Adds where each block would have most neighbours, and how many; ties are spread over the shards."""
    votes = blocks.groupBy("key", "shard").agg(F.sum("n").alias("_votes"))
    most = votes.groupBy("key").agg(F.max(F.struct("_votes", F.xxhash64("key", "shard"), "shard")).alias("_most"))
    return blocks.join(
        most.select("key", F.col("_most.shard").alias("wish"), F.col("_most._votes").alias("friends")), "key",
    ).withColumn("level", F.floor(F.log2(F.col("friends").cast("double"))).cast("int"))


def _admission(asked: list, held: dict[int, int], quota: list[int]) -> dict[tuple[int, int], float]:
    """Share of each (shard, level) class of movers that its shard has room for.

    ``asked`` has one row per class: at most shards x 64 rows at any size.
    """
    shares = {}
    room = {s: max(0, q - held.get(s, 0)) for s, q in enumerate(quota)}
    for row in sorted(asked, key=lambda r: (r["wish"], -r["level"])):
        free = room[row["wish"]]
        shares[row["wish"], row["level"]] = 1.0 if row["n"] <= free else FILL * free / row["n"]
        room[row["wish"]] = free - row["n"] if row["n"] <= free else 0
    return shares


def propagate(blocks: DataFrame, quota: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Blocks after the moves: (key, home, n, shard)."""
    for turn in range(rounds):
        wishes = settle(_wishes(blocks))
        movers = wishes.where(F.col("wish") != F.col("shard"))
        asked = movers.groupBy("wish", "level").agg(F.sum("n").alias("n")).collect()
        if not asked:
            return wishes.select("key", "home", "n", "shard")
        held = {r["shard"]: r["n"] for r in wishes.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        shares = _admission(asked, held, quota)
        share = F.create_map(*[F.lit(x) for (s, level), v in shares.items() for x in (f"{s}:{level}", float(v))])
        draw = F.pmod(F.xxhash64("key", "home", F.lit(turn)), F.lit(DRAWS)) / DRAWS
        admitted = draw < share[F.concat_ws(":", "wish", "level")]
        blocks = wishes.select(
            "key", "home", "n",
            F.when((F.col("wish") != F.col("shard")) & admitted, F.col("wish")).otherwise(F.col("shard")).alias("shard"),
        )
    return settle(blocks)


def _pick(values: list[int], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), (at + 1).cast("int"))


def balanced_shards(rows: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """Adds shard and slot to rows of (doc_id, key, ...); ``rows`` must not change between reads."""
    total = rows.count()
    quota = quotas(total, shards)
    rows = rows.withColumn("home", F.pmod(F.xxhash64("doc_id", "row"), F.lit(shards)).cast("int"))
    blocks = propagate(_blocks(rows), quota, rounds)
    linked = join_facts(rows, blocks, ["key", "home"], "n", total)
    alone = _alone(rows).withColumn("shard", F.lit(shards))
    bucket = F.pmod(F.xxhash64("key"), F.lit(KEY_BUCKETS)) * DOC_BUCKETS + F.pmod(F.xxhash64("doc_id", "row"), F.lit(DOC_BUCKETS))
    placed = numbered(
        linked.unionByName(alone).withColumn("_bucket", bucket), "shard", "_bucket",
        [F.col("key"), F.col("doc_id"), F.col("row")], "_rank",
    ).drop("_bucket")

    held = {r["shard"]: r["n"] for r in blocks.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    stay = [min(held.get(s, 0), q) for s, q in enumerate(quota)]
    over = [max(0, held.get(s, 0) - q) for s, q in enumerate(quota)]
    room = [q - s for q, s in zip(quota, stay)]
    # Rows beyond a quota come first in the queue, shard after shard, then those without links.
    queue_start = [sum(over[:s]) for s in range(shards + 1)]
    room_start = [sum(room[:s]) for s in range(shards)]

    stays = (F.col("shard") < shards) & (F.col("_rank") < _pick([*stay, 0], F.col("shard")))
    turn = _pick(queue_start, F.col("shard")) + F.col("_rank") - _pick([*stay, 0], F.col("shard"))
    starts = F.array(*[F.lit(x).cast("long") for x in room_start])
    # The last shard with room whose first free place is not beyond the turn.
    open_shard = F.array_max(F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.when((F.element_at(starts, s + 1) <= F.col("_turn")) & (_pick(room, s) > 0), s).otherwise(-1),
    ))
    return (
        placed.withColumn("_turn", F.when(~stays, turn))
        .withColumn("_open", F.when(F.col("_turn").isNotNull(), open_shard))
        .withColumn("slot", F.when(F.col("_turn").isNull(), F.col("_rank")).otherwise(
            _pick(stay, F.col("_open")) + F.col("_turn") - _pick(room_start, F.col("_open"))))
        .withColumn("shard", F.coalesce("_open", "shard").cast("int"))
        .drop("home", "_rank", "_turn", "_open")
    )


def _alone(rows: DataFrame) -> DataFrame:
    """Rows whose key no other row has; other keys are reduced to a row per task before the shuffle."""
    others = [c for c in rows.columns if c != "key"]
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in others]).where(F.col("_n") == 1).drop("_n")


def document_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, key, row), written once; equal texts have equal keys."""
    return settle(docs.select(
        "doc_id", (F.octet_length(text_of()) + 8).cast("long").alias("size"), F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text_of(), 256)).alias("key"), F.monotonically_increasing_id().alias("row"),
    ))


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    return balanced_shards(document_rows(docs), shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )

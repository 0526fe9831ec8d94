"""Near-duplicate documents by SimHash fingerprints and fuzzy Golay keys.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits, the last one
filled up with zeros. The binary Golay code of 23 bits is perfect: every word is
at most three bits from exactly one codeword. A word's keys are the numbers of
all codewords at most four bits away: one, or six when the nearest is three
bits away. Two words that differ in at most two bits share a key. Of at most four
differing bits over three segments, either no segment has more than two, and the
fingerprints share a key of all three segments; or one segment has three or
four, so of the other two one is equal and the other differs in one bit at most:
they share that segment as it is with a key of the other. A key has 35 or 36
bits, so that fingerprints of different texts rarely meet in one even among
billions. Keys are joined and the distance verified.

Equal fingerprints are one node. Keys are shuffled once and read in order; the
members of a key are compared with each other, and of the links found only as
many are kept as connect the same members, so a dense group never becomes all
its pairs. A key with more than LONG_RUN members is not held by a task: its
members are first compared with the smallest one; then those that are not
connected yet are compared in parts, every pair of parts by a task of its own.
No link that joins two groups is lost.

Defined results: null counts as empty; a text without words has fingerprint
zero; rows with equal ids are separate rows; null ids lose against any other as
component; an empty table gives an empty result; a very long text is hashed in
parts by one task; other columns do not matter and may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.components import components
from siltstone.llm.keys import boxed, join_facts, text_of, unboxed
from siltstone.session import settle, ship_package, small_batches

SHINGLE = 4
MOST_BITS = 4
# Fixed value: the seed of the shingle hash.
SEED = 42
# Hashes whose bits are counted at a time.
PART = 1 << 14

# Members of a key up to which all pairs are compared at once, and from which a task does not hold them.
SHORT_RUN, LONG_RUN = 64, 8192

# Fixed value: the generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b101011100011
SEGMENTS = ((0, 23), (23, 23), (46, 18))
NEAR = 4


def codewords() -> np.ndarray:
    """All 4096 codewords; the upper twelve bits of each are its number."""
    words = np.arange(4096, dtype=np.uint32) << 11
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, np.uint32(GENERATOR << (bit - 11)), np.uint32(0))
    return words | rest


def error_keys() -> np.ndarray:
    """By the low eleven bits of a word less the codeword with its upper bits: that codeword is added to these.

    Six numbers per remainder: what to change in a word's number to get each near codeword's, -1 where there are fewer.
    """
    words = codewords()
    keys = np.full((2048, 6), -1, np.int16)
    for remainder in range(2048):
        # The word ``remainder`` has number 0; all others with this remainder are shifted by a codeword.
        near = np.flatnonzero(np.bitwise_count(words ^ np.uint32(remainder)) <= NEAR)
        keys[remainder, : len(near)] = near
    return keys


class Golay:
    """Keys of 23-bit words."""

    def __init__(self):
        self.words, self.errors = codewords(), error_keys()

    def keys(self, segment: np.ndarray) -> np.ndarray:
        """Six numbers of near codewords per word, -1 where there are fewer."""
        number = (segment >> 11).astype(np.int64)
        near = self.errors[(segment.astype(np.uint32) ^ self.words[number]) & 0x7FF]
        return np.where(near < 0, -1, near ^ number[:, None])


def fuzzy_keys(golay: Golay, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): up to 216 keys of all segments, and up to 6 for each of the six ways to take one segment as it is with a key of another."""
    prints = prints.view(np.uint64)
    words = [((prints >> np.uint64(start)) & np.uint64((1 << width) - 1)).astype(np.int64) for start, width in SEGMENTS]
    near = [golay.keys(w) for w in words]
    a, b, c = near[0][:, :, None, None], near[1][:, None, :, None], near[2][:, None, None, :]
    families = [((a >= 0) & (b >= 0) & (c >= 0), a << 24 | b << 12 | c)]
    families += [(near[y] >= 0, words[x][:, None] << 12 | near[y]) for x, y in permutations(range(3), 2)]
    rows, keys = [], []
    for family, (there, key) in enumerate(families):
        row, at = np.nonzero(np.broadcast_to(there, key.shape).reshape(len(prints), -1))
        rows.append(row)
        keys.append(family << 36 | key.reshape(len(prints), -1)[row, at])
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: str) -> int:
    """Bits set in over half of the hashes of all word shingles; ASCII white space parts words, A-Z is lowered."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    ends = (ends[SHINGLE - 1 :] - 1).tolist() or [len(joined)]
    counts = np.zeros(64, np.int64)
    hash_of = xxhash.xxh64_intdigest
    for at in range(0, len(ends), PART):
        hashes = np.fromiter((hash_of(joined[a:b], SEED) for a, b in zip(starts[at : at + PART], ends[at : at + PART])), np.uint64)
        counts += _bit_counts(hashes)
    return int(np.packbits(counts * 2 > len(ends), bitorder="little").view(np.uint64)[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, lowest first."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _digest() -> Column:
    """Tells rows with the same id apart."""
    return F.xxhash64(text_of())


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, print), written once; the fingerprint is a signed long."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("digest", T.LongType()), T.StructField("print", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py() or "") for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(prints)], names=schema.names)

    with small_batches(docs.sparkSession):
        return settle(docs.select("doc_id", _digest().alias("digest"), "text").mapInArrow(run, schema))


def keyed(nodes: DataFrame) -> DataFrame:
    """(key, print): a row per fuzzy key of every fingerprint."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("print", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = Golay()
        for batch in batches:
            prints = batch.column("print").to_numpy()
            for at in range(0, len(prints), 2048):
                part = prints[at : at + 2048]
                row, key = fuzzy_keys(golay, part)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], names=schema.names)

    return nodes.select("print").mapInArrow(run, schema)


def _close(a: Column, b: Column, bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= bits


def _pairs_of_runs(keys: np.ndarray, prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of close fingerprints with equal keys; keys are in order."""
    found = []
    at, step = np.arange(len(keys)), 1
    while len(at):
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        close = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= bits]
        found.append((close, close + step))
        step += 1
    left, right = zip(*found) if found else ((), ())
    return np.concatenate([[], *left]).astype(np.int64), np.concatenate([[], *right]).astype(np.int64)


def _forest(prints: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(place, places linked to it): enough links to connect what all close pairs would."""
    left = np.arange(len(prints))
    while len(left):
        reached, left = [int(left[0])], left[1:]
        while reached and len(left):
            at = reached.pop()
            close = np.bitwise_count(prints[left] ^ prints[at]) <= bits
            if close.any():
                yield at, left[close]
                reached += left[close].tolist()
                left = left[~close]


def links_of_run_rows(keys: np.ndarray, prints: np.ndarray, bits: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole runs of equal keys. Those longer than ``longest``, or with more close pairs than members, give a forest."""
    prints = prints.view(np.uint64)  # numpy counts the bits of a negative number's magnitude
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    sizes = np.diff(starts, append=len(keys))
    run = np.repeat(np.arange(len(starts)), sizes)
    short = sizes <= longest
    places = np.flatnonzero(short[run])
    i, j = _pairs_of_runs(keys[places], prints[places], bits)
    i, j = places[i], places[j]
    dense = np.bincount(run[i], minlength=len(starts)) > sizes
    sparse = ~dense[run[i]]
    a, b = [prints[i[sparse]]], [prints[j[sparse]]]
    for r in np.flatnonzero(dense | ~short):
        mine = prints[starts[r] : starts[r] + sizes[r]]
        for at, linked in _forest(mine, bits):
            a.append(np.full(len(linked), mine[at]))
            b.append(mine[linked])
    return np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)


def key_links(keys: DataFrame, bits: int) -> DataFrame:
    """(hot, a, b), written once: links (a, b) of fingerprints within keys, or (key, fingerprint) of long runs.

    Keys are sorted within their task and read as a stream. A key with more
    than LONG_RUN fingerprints is not held but handed on row by row.
    """
    short_run, long_run = SHORT_RUN, LONG_RUN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(keys: np.ndarray, prints: np.ndarray, hot: bool) -> pa.RecordBatch:
            if not hot:
                pair = np.unique(np.stack(links_of_run_rows(keys, prints, bits, short_run), axis=1), axis=0)
                keys, prints = pair[:, 0], pair[:, 1]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), hot)), pa.array(keys.astype(np.int64)), pa.array(prints)], names=["hot", "a", "b"])

        held_keys, held_prints, long_key = np.empty(0, np.int64), np.empty(0, np.int64), None
        for batch in batches:
            held_keys = np.append(held_keys, batch.column("key").to_numpy())
            held_prints = np.append(held_prints, batch.column("print").to_numpy())
            if not len(held_keys):
                continue
            if long_key is not None:
                end = np.searchsorted(held_keys, long_key, side="right")
                yield links(held_keys[:end], held_prints[:end], True)
                held_keys, held_prints = held_keys[end:], held_prints[end:]
                if not len(held_keys):
                    continue
                long_key = None
            last = np.searchsorted(held_keys, held_keys[-1], side="left")
            yield links(held_keys[:last], held_prints[:last], False)
            held_keys, held_prints = held_keys[last:], held_prints[last:]
            if len(held_keys) > long_run:
                long_key = held_keys[-1]
                yield links(held_keys, held_prints, True)
                held_keys, held_prints = held_keys[:0], held_prints[:0]
        yield links(held_keys, held_prints, False)

    return settle(keys.repartition("key").sortWithinPartitions("key").mapInArrow(run, "hot boolean, a long, b long"))


def linked_prints(nodes: DataFrame, bits: int) -> DataFrame:
    """(node, label): fingerprints that have a link, with the smallest that can be reached.

    ``nodes`` are distinct fingerprints.
    """
    found = key_links(keyed(nodes), bits)
    links = found.where("not hot").select("a", "b")
    members = found.where("hot").select(F.col("a").alias("key"), F.col("b").alias("print"))
    if members.limit(1).count() == 0:
        return components(links)
    # Long runs: first every member with the smallest, then those that are not connected yet with each other.
    least = members.groupBy("key").agg(F.min("print").alias("least"), F.count(F.lit(1)).alias("_n"), F.count(F.lit(1)).alias("size"))
    told = settle(join_facts(members, least, ["key"], "_n", members.count()))
    star = told.where((F.col("print") != F.col("least")) & _close(F.col("print"), F.col("least"), bits)).select(
        F.col("print").alias("a"), F.col("least").alias("b"))
    groups = components(links.unionByName(star))
    parts = F.ceil(F.col("size") / LONG_RUN)
    labelled = told.join(groups.withColumnRenamed("node", "print"), "print", "left").select(
        "key", "print", F.coalesce("label", "print").alias("label"),
        F.pmod(F.xxhash64("print"), parts).alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("other"))
    left = labelled.select("key", F.col("own").alias("i"), F.col("other").alias("j"), F.col("print").alias("a"), F.col("label").alias("label_a"))
    right = labelled.select("key", F.col("other").alias("i"), F.col("own").alias("j"), F.col("print").alias("b"), F.col("label").alias("label_b"))
    rest = left.join(right, ["key", "i", "j"]).where(
        (F.col("label_a") < F.col("label_b")) & _close(F.col("a"), F.col("b"), bits)
    ).select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    known = groups.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
    return components(known.unionByName(rest))


def _near_rows(docs: DataFrame, bits: int) -> DataFrame:
    """(doc_id, digest, print, label, component_id): the label tells components apart, whatever their ids."""
    ship_package(docs.sparkSession)
    rows = fingerprints(docs)
    nodes = settle(rows.groupBy("print").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("_rows")))
    groups = linked_prints(nodes, bits)
    joined = nodes.join(groups.withColumnRenamed("node", "print"), "print", "left").withColumn("label", F.coalesce("label", "print"))
    heads = joined.groupBy("label").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("_nodes"))
    placed = join_facts(joined, heads, ["label"], "_nodes", nodes.count()).select("print", "label", "component_id", "_rows")
    return join_facts(rows, settle(placed), ["print"], "_rows", rows.count())


def near_groups(docs: DataFrame, bits: int = MOST_BITS) -> DataFrame:
    """doc_id, fingerprint, component_id."""
    return _near_rows(docs, bits).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near(docs: DataFrame, bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of every component one with its id."""
    stay = (
        _near_rows(docs, bits).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("label").agg(F.min("digest").alias("_stay_digest"), F.min("doc_id").alias("_stay_id"))
        .select("_stay_id", "_stay_digest").distinct()
    )
    same = F.col("_id").eqNullSafe(F.col("_stay_id")) & (F.col("_digest") == F.col("_stay_digest"))
    one = Window.partitionBy("_id", "_digest").orderBy(F.lit(0))
    kept = boxed(docs, _id=F.col("doc_id"), _digest=_digest()).join(stay, same, "left_semi").withColumn("_place", F.row_number().over(one))
    return unboxed(kept.where("_place = 1"), docs.columns)

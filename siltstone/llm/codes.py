"""Vectors as short codes: product quantisation in whole numbers, assigned by way of a trie.

A vector's components become floor(256 * x) and are cut into equal parts, each
with a codebook of its own. A task sorts the distinct parts of its rows by
their components. They are the leaves of a lexicographic trie: parts that begin
with the same components share the path there, and with it the distances of
this beginning to all entries, added up once. The trie is walked depth first,
so that only the open path is held; a subtree with few leaves is worked out
level by level as one array. A leaf takes its nearest entry, and counts there as
often as its part occurs. Per round a task hands over one row per entry, its
weighted sums, whatever the number of vectors: no vector is ever shuffled.

Defined results: rows whose vector is null or holds null or non-finite
components are dropped; a vector of another length than the longest is filled
up with zeros, and so is the last part if the parts do not divide the length;
rows with equal ids are separate rows, and of the first rows by id the one with
the smaller components comes first, null ids last; with fewer rows than entries
every row is an entry; null labels count together; an empty table gives an
empty result; other columns do not matter, and there are no texts. Components
whose squared distances do not fit 63 bits are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.keys import join_facts
from siltstone.llm.vectors import extent, matrix, scaled, sound
from siltstone.session import settle, ship_package

PARTS, ENTRIES, ROUNDS = 16, 64, 2
# Leaves of a subtree that is worked out as one array, and rows whose parts are sorted together.
MOST_LEAVES = 1 << 12
MOST_ROWS = 1 << 15


def assign(parts: np.ndarray, entries: np.ndarray, most_leaves: int = MOST_LEAVES) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each part's nearest entry; ``parts`` are distinct, in lexicographic order."""
    n, width = parts.shape
    nearest, distance = np.empty(n, np.int64), np.empty(n, np.int64)
    # changed[d] tells where a prefix of d + 1 components begins.
    changed = np.ones((width, n), bool)
    if n > 1:
        changed[:, 1:] = np.logical_or.accumulate(parts[1:] != parts[:-1], axis=1).T

    def longer(along: np.ndarray, depth: int, starts: np.ndarray) -> np.ndarray:
        """Distances of prefixes one component longer than those of ``along``."""
        step = parts[starts, depth, None] - entries[None, :, depth]
        return along + step * step

    def leaves(first: int, last: int, depth: int, along: np.ndarray) -> None:
        """All levels below a node, whose distances are ``along``, as arrays."""
        owner = np.zeros(last - first, np.int64)
        along = along[None, :]
        for d in range(depth, width):
            begins = changed[d, first:last].copy()
            begins[0] = True
            starts = np.flatnonzero(begins)
            along = longer(along[owner[starts]], d, starts + first)
            owner = np.cumsum(begins) - 1
        found = along.argmin(axis=1)  # the first of equal ones
        nearest[first:last] = found
        distance[first:last] = along[np.arange(len(found)), found]

    # Open nodes, the leftmost on top: (first leaf, end, depth, distances of the prefix).
    open_nodes = [(0, n, 0, np.zeros(len(entries), np.int64))] if n else []
    while open_nodes:
        first, last, depth, along = open_nodes.pop()
        if last - first <= most_leaves or depth == width:
            leaves(first, last, depth, along)
            continue
        begins = changed[depth, first:last].copy()
        begins[0] = True
        starts = np.flatnonzero(begins) + first
        ends = np.append(starts[1:], last)
        below = longer(along[None, :], depth, starts)
        open_nodes += [(int(s), int(e), depth + 1, b) for s, e, b in zip(starts[::-1], ends[::-1], below[::-1])]
    return nearest, distance


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, each row's place among them, and how often each occurs."""
    order = np.lexsort(parts.T[::-1])
    ordered = parts[order]
    begins = np.ones(len(parts), bool)
    begins[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(begins) - 1
    starts = np.flatnonzero(begins)
    return ordered[starts], place, np.diff(np.append(starts, len(parts)))


def _tables(batches: Iterator[pa.RecordBatch], most_rows: int) -> Iterator[pa.Table]:
    """A task's rows in tables of about ``most_rows``."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= most_rows:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _cut(rows: pa.Table, width: int, parts: int) -> np.ndarray:
    """(row, part, component)."""
    return matrix(rows["numbers"], parts * width).reshape(rows.num_rows, parts, width)


def part_sums(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, place, rows, total): per entry, its parts' number and the sums of their components."""
    parts, _, width = books.shape
    most_rows = MOST_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, totals = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for table in _tables(batches, most_rows):
            cut = _cut(table, width, parts)
            for p in range(parts):
                found, _, weight = distinct_parts(cut[:, p])
                nearest, _ = assign(found, books[p])
                np.add.at(rows[p], nearest, weight)
                np.add.at(totals[p], nearest, found * weight[:, None])
        part, entry = np.nonzero(rows)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(np.repeat(part, width), pa.int32()), "entry": pa.array(np.repeat(entry, width), pa.int32()),
            "place": pa.array(np.tile(np.arange(width), len(part)), pa.int32()),
            "rows": np.repeat(rows[part, entry], width), "total": totals[part, entry].ravel(),
        })

    found = vectors.select("numbers").mapInArrow(run, "part int, entry int, place int, rows long, total long")
    return found.groupBy("part", "entry", "place").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"))


def first_books(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """(part, entry, component): the parts of the first rows by id."""
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "numbers").limit(entries).select("numbers").toArrow()
    return _cut(first, width, parts).transpose(1, 0, 2)


def train(vectors: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after so many rounds. Parts x entries x components numbers come to the driver, however many rows there are."""
    for _ in range(rounds):
        books = books.copy()
        for r in part_sums(vectors, books).collect():
            books[r["part"], r["entry"], r["place"]] = r["total"] // r["rows"]
    return books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): two hex digits per part, and the squared distance to the entries."""
    parts, _, width = books.shape
    most_rows = MOST_ROWS
    schema = T.StructType([vectors.schema["vec_id"], vectors.schema["label"]] + T.StructType.fromDDL("code string, error long").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = np.frombuffer(bytes.fromhex("".join(f"{ord(c):02x}" for k in range(256) for c in f"{k:02x}")), np.uint8).reshape(256, 2)
        for table in _tables(batches, most_rows):
            cut = _cut(table, width, parts)
            codes, error = np.empty((table.num_rows, parts), np.int64), np.zeros(table.num_rows, np.int64)
            for p in range(parts):
                found, place, _ = distinct_parts(cut[:, p])
                nearest, distance = assign(found, books[p])
                codes[:, p] = nearest[place]
                error += distance[place]
            text = digits[codes].reshape(table.num_rows, 2 * parts).tobytes().decode()
            step = 2 * parts
            yield pa.RecordBatch.from_arrays([
                table["vec_id"].combine_chunks(), table["label"].combine_chunks(),
                pa.array([text[i * step : (i + 1) * step] for i in range(table.num_rows)], pa.string()), pa.array(error),
            ], names=["vec_id", "label", "code", "error"])

    return vectors.select("vec_id", "label", "numbers").mapInArrow(run, schema)


def vector_codes(
    embeddings: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256; up to 256 entries."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits per part")
    ship_package(embeddings.sparkSession)
    vectors = embeddings.where(sound(vector)).select("vec_id", "label", scaled(vector).alias("numbers"))
    length, most = extent(vectors, "numbers")
    width = -(-length // parts)
    if (2 * most) ** 2 * max(1, parts * width) >= 1 << 63:
        raise ArithmeticError("squared distances of these vectors do not fit 63 bits")
    books = train(vectors, first_books(vectors, width, parts, entries), rounds)
    coded = settle(encode(vectors, books).withColumn(
        "_label", F.when(F.col("label").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("label").cast("string")))))
    sums = coded.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_rows"))
    return join_facts(coded, sums, ["_label"], "_rows", coded.count()).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))

"""Best-fit packing of documents into token sequences after a dominance reduction.

Which pieces share a sequence depends on their lengths only, and there are at
most CAPACITY different lengths. So the instance is the number of pieces per
length: it is counted in Spark, reduced and packed on the driver as classes of
equal pieces, and the resulting plan, bounded by the capacity and not by the
corpus, is applied to numbered pieces in Spark.

The reduction follows Martello and Toth. Taking the longest remaining piece,
* if no other piece fits beside it, it stays alone;
* if some piece fills the rest exactly, the two dominate every other set;
* if no two pieces fit beside it, it and the longest that fits dominate.
What no rule settles is packed best fit, longest first, a class at a time.

Defined results: a null or empty text is a piece with its end id alone; rows
with equal ids are separate documents; an empty table gives no sequences; other
columns do not matter.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.keys import numbered
from siltstone.llm.units import UnitTable, parts_by_size
from siltstone.session import settle, ship_package, small_batches

CAPACITY = 2048
END_ID = 0
# Buckets in which pieces of one length are numbered.
BUCKETS = 256


# Letters up to a blank or a sign after which no word, contraction or special token of the tokenizer can go on.
WORD = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"
UNITS = re.compile(WORD + r"(?![^ \t\r\n.,;:!?#$%&*()])|[^ \t\r\n]+")
LATIN = re.compile("[\x00-\xff]*")
# Distinct units from which a generation of remembered ones is full.
MOST_UNITS = 1 << 17
# Words encoded as one text.
WORDS_AT_ONCE = 512


class WordEncoder:
    """Ids by the tokenizers library, for a tokenizer that lowers case, drops blanks and marks the ends of words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")
        self.table = UnitTable(self._unit_ids, MOST_UNITS, self._units)

    def _each(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def _unit_ids(self, units: list[str]) -> list[list[int]]:
        """Plain words are encoded many at a time and parted at the ends of words; other units one by one."""
        is_word = [re.fullmatch(WORD, u) is not None for u in units]
        words = [u for u, w in zip(units, is_word) if w]
        found: list[list[int]] = []
        for at in range(0, len(words), WORDS_AT_ONCE):
            part = words[at : at + WORDS_AT_ONCE]
            ids = self._each([" ".join(part)])[0]
            ends = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
            found += [ids[a:b] for a, b in zip([0, *ends], ends)] if len(ends) == len(part) else self._each(part)
        of_words, of_others = iter(found), iter(self._each([u for u, w in zip(units, is_word) if not w]))
        return [next(of_words if w else of_others) for w in is_word]

    def _units(self, chunk: str) -> list[str]:
        if chunk.isascii() and chunk.isalpha():
            return [chunk]
        if "<|" not in chunk and LATIN.fullmatch(chunk):
            chunk = chunk.lower()
        return UNITS.findall(chunk)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of whole texts. Chunks between blanks never share a token in a tokenizer that drops white space.

        Lower case makes fewer chunks; it is left to the tokenizer where it could make or hide a special token.
        """
        texts = texts.fill_null("")
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        return self.table.encode(pc.ascii_split_whitespace(texts))


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of this process: later tasks find the units that earlier ones have met."""
    return WordEncoder(path)


def cut(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids followed by the end id."""
    ids = np.append(ids, END_ID).astype("<u4")
    for piece, start in enumerate(range(0, len(ids), capacity)):
        part = ids[start : start + capacity]
        yield piece, start, len(part), zlib.crc32(part.tobytes())


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, row), written once: texts are encoded once."""
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("row", T.LongType()), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in batches:
            for first, last in parts_by_size(batch.column("text")):
                at, found = [], []
                for i, ids in enumerate(encoder.encode(batch.column("text").slice(first, last - first)), first):
                    for piece in cut(ids, capacity):
                        at.append(i)
                        found.append(piece)
                yield _rows(batch, at, found)
            pa.default_memory_pool().release_unused()

    def _rows(batch: pa.RecordBatch, at: list[int], found: list[tuple]) -> pa.RecordBatch:
        piece, start, length, crc = zip(*found)
        ids = batch.select(["doc_id", "row"]).take(pa.array(at))
        return pa.RecordBatch.from_arrays(
            [*ids.columns, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
            names=["doc_id", "row", "piece", "start", "length", "ids_crc32"],
        )

    with small_batches(docs.sparkSession):
        return settle(
            docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(encode, schema))


@dataclass
class Bins:
    """Equal sequences: how many, what each holds as (length, pieces) pairs, and the room left in each."""

    count: int
    holds: tuple[tuple[int, int], ...]
    room: int


def reduce_by_dominance(pieces: Counter, capacity: int) -> list[Bins]:
    """Takes out of ``pieces`` (length to number) the sets that dominate, and returns them as bins.

    A set fixed makes the instance smaller, so that rules may hold that did not
    before; passes are repeated until one fixes nothing.
    """
    fixed: list[Bins] = []
    lengths = sorted(n for n in pieces if pieces[n])

    def companion(j: int) -> int | None:
        """The longest other piece that fits beside a piece of length j."""
        at = bisect_left(lengths, capacity - j + 1) - 1
        if at >= 0 and lengths[at] == j and pieces[j] == 1:
            at -= 1
        return lengths[at] if at >= 0 else None

    def two_fit(j: int) -> bool:
        """Whether two other pieces fit beside a piece of length j."""
        least = [n for n in lengths[:3] for _ in range(min(2, pieces[n] - (n == j)))][:2]
        return len(least) == 2 and sum(least) <= capacity - j

    def take(count: int, *members: int) -> None:
        held = Counter(members)
        for m, times in held.items():
            pieces[m] -= count * times
            if not pieces[m]:
                lengths.pop(bisect_left(lengths, m))
        fixed.append(Bins(count, tuple(sorted(held.items(), reverse=True)), capacity - sum(members)))

    before = -1
    while before < len(fixed):
        before = len(fixed)
        for j in lengths[::-1]:
            while pieces[j]:
                k = companion(j)
                if k is None:
                    take(pieces[j], j)
                elif k + j == capacity or not two_fit(j):
                    take(pieces[j] // 2 if k == j else min(pieces[j], pieces[k]), j, k)
                else:
                    break
    return fixed


def best_fit(pieces: Counter, capacity: int) -> list[Bins]:
    """Best fit, longest first: each piece goes where least room is left; equal bins are filled as one class."""
    by_room: dict[int, list[Bins]] = {}
    rooms: list[int] = []
    done: list[Bins] = []

    def put(bins: Bins) -> None:
        if not bins.count:
            return
        if not bins.room:
            done.append(bins)
            return
        if bins.room not in by_room:
            by_room[bins.room] = []
            insort(rooms, bins.room)
        by_room[bins.room].append(bins)

    def fill(bins: Bins, length: int, left: int) -> int:
        """Puts pieces into some of the bins, as many in each as fit; returns how many are left."""
        each = min(bins.room // length, left)
        used = min(bins.count, left // each)
        put(Bins(bins.count - used, bins.holds, bins.room))
        put(Bins(used, (*bins.holds, (length, each)), bins.room - each * length))
        return left - used * each

    for length in sorted(pieces, reverse=True):
        left = pieces[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                bins = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                    rooms.pop(at)
            else:
                bins = Bins(-(-left // (capacity // length)), (), capacity)
            left = fill(bins, length, left)
    done += [b for same in by_room.values() for b in same]
    return [b for b in done if b.holds]


def plan(pieces: dict[int, int], capacity: int) -> list[Bins]:
    left = Counter(pieces)
    return reduce_by_dominance(left, capacity) + best_fit(+left, capacity)


def plan_table(bins: list[Bins]) -> dict[str, np.ndarray]:
    """Per length and first number: the sequences that its pieces go to, how many to each, and the offset there."""
    rows, next_number, sequence = [], Counter(), 0
    for b in bins:
        offset = 0
        for length, each in b.holds:
            rows.append((length, next_number[length], sequence, each, offset))
            next_number[length] += b.count * each
            offset += length * each
        sequence += b.count
    rows.sort()
    names = ("length", "first", "sequence", "each", "offset")
    return dict(zip(names, np.array(rows, np.int64).reshape(-1, 5).T))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    ship_package(docs.sparkSession)
    pieces = pieces_of(docs, tokenizer, capacity)
    counted = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    table = plan_table(plan({r["length"]: r["n"] for r in counted}, capacity))
    bucket = F.pmod(F.xxhash64("row", "piece"), F.lit(BUCKETS)).cast("int")
    ranked = numbered(pieces.withColumn("_bucket", bucket), "length", "_bucket", [F.col("row"), F.col("piece")], "_number")
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_number")
    schema = T.StructType(
        [f for f in ranked.schema.fields if f.name != "_number"]
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of the plan are sorted by length, then by first number.
        first_row = {int(n): int(at) for at, n in reversed(list(enumerate(table["length"])))}
        rows_of = Counter(table["length"].tolist())
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("_number").to_numpy()
            at = np.empty(len(length), np.int64)
            for n in np.unique(length):
                lo, mine = first_row[int(n)], length == n
                hi = lo + rows_of[int(n)]
                at[mine] = lo + np.searchsorted(table["first"][lo:hi], number[mine], side="right") - 1
            turn = number - table["first"][at]
            each = table["each"][at]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(schema.names[:-2]).columns, pa.array(table["sequence"][at] + turn // each),
                 pa.array(table["offset"][at] + turn % each * length)], names=schema.names)

    return ranked.mapInArrow(place, schema)

"""Document fingerprints by locally consistent parsing.

A text is parsed bottom up. On each level runs of a repeated symbol become one
symbol; then deterministic coin tossing compares every symbol with the one
before it and keeps the place and value of their lowest differing bit, four
times, until six labels are left of which no two neighbours are equal. Phrases
start at local minima of the labels. A phrase's name is a hash of its symbols,
and names are the symbols of the next level. Where a phrase starts depends on a
few symbols around it only, so equal passages get equal names inside, wherever
they stand. The fingerprint is the multiset of names on the levels in LEVELS,
and on all higher ones on which the text has enough phrases, with the members of
long runs, reduced to the smallest hashes of (name, occurrence): KEPT of them or
one in SHARE, whichever is more, so that it grows with the text. Two
fingerprints are compared below the bound up to which both are whole, an
estimate of how much of the two multisets is shared.

Texts are sorted by descending id over range partitions. A task pairs every text
with the next one; the last text of a partition meets the first of the next
partition that is not empty, one row each, in a join.

Defined results: null counts as empty; an empty text has an empty fingerprint,
which is like another empty one (1) and unlike any other (0); rows with equal
ids follow each other by their text's hash; null ids come last; of an empty
table the result is empty; a very long text is parsed by one task, its hashes
held; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from siltstone.llm.keys import text_of
from siltstone.session import ship_package, shuffle_width

# Levels whose names are always kept: a phrase on level 2 has about ten characters, on level 3 about thirty, and so on.
# Higher ones count where the text has at least PHRASES there.
LEVELS = (2, 3)
PHRASES = 8
# Names of a fingerprint: so many, or one in SHARE.
KEPT, SHARE = 64, 8
# Runs from this length count as so many names of their symbol, however long they are.
LONG_RUN = 3
# Coin tossing of 64-bit names leaves 128, 14, 8 and then 6 labels.
TOSSES = 4
# Characters parsed at a time.
CHUNK = 1 << 19

# Odd multipliers of the hash, and the powers that tell places in a phrase apart.
STIR = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
POWER = 0x5851F42D4C957F2D
LONGEST = 64


def stirred(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixture of each value."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(STIR[0])
    x = (x ^ (x >> np.uint64(29))) * np.uint64(STIR[1])
    return x ^ (x >> np.uint64(32))


POWERS = np.cumprod(np.full(LONGEST, POWER, np.uint64))


def _toss_table() -> np.ndarray:
    """Next label by (label, label before), for labels below 128; equal ones count as differing in the lowest bit."""
    own, before = np.arange(128)[:, None], np.arange(128)[None, :]
    differ = np.where(own == before, 1, own ^ before)
    place = np.log2(differ & -differ).astype(np.int64)
    return (2 * place + ((own >> place) & 1)).astype(np.uint8).reshape(-1)


NEXT_LABEL = _toss_table()


def labels_of(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6 after TOSSES rounds; a text's first symbol is compared with its own complement."""
    differ = np.empty_like(symbols)
    differ[1:] = symbols[1:] ^ symbols[:-1]
    differ[first] = 1
    place = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.uint64)
    label = (np.uint64(2) * place + ((symbols >> place) & np.uint64(1))).astype(np.uint8)
    for _ in range(TOSSES - 1):
        pair = label.astype(np.uint16) << 7
        pair[1:] |= label[:-1]
        pair[first] = (label[first].astype(np.uint16) << 7) | (label[first] ^ 1)
        label = NEXT_LABEL[pair]
    return label


def parsed(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names of the phrases of several texts in a row, and the places in them where texts start.

    ``first`` are the places where texts start; no text is empty. Also returned:
    the members of long runs, and the places in them where texts start.
    """
    begins = np.empty(len(symbols), bool)
    begins[1:] = symbols[1:] != symbols[:-1]
    begins[first] = True
    runs = np.flatnonzero(begins)
    length = np.diff(runs, append=len(symbols)).astype(np.uint64)
    first = np.cumsum(begins, dtype=np.int64)[first] - 1
    symbols = symbols[runs]
    members = np.where(length >= LONG_RUN, length, 0).astype(np.int64)
    repeated, repeated_first = np.repeat(symbols, members), (np.cumsum(members) - members)[first]
    long = length > 1
    symbols[long] = stirred(symbols[long] + stirred(length[long]))

    label = labels_of(symbols, first)
    lower = np.zeros(len(symbols), bool)
    lower[1:] = label[1:] < label[:-1]
    rises = np.zeros(len(symbols), bool)
    rises[:-1] = label[:-1] < label[1:]
    rises[first[1:] - 1] = False  # a text's last symbol has none after it
    opens = lower & rises
    opens[first] = True
    start = np.flatnonzero(opens)
    phrase = np.cumsum(opens, dtype=np.int64) - 1
    place = np.arange(len(symbols)) - start[phrase]
    names = stirred(np.add.reduceat(stirred(symbols) * POWERS[np.minimum(place, LONGEST - 1)], start))
    return names, phrase[first], repeated, repeated_first


def counted(names: np.ndarray) -> np.ndarray:
    """Hashes of (name, occurrence): what a multiset of names is compared by."""
    names = np.sort(names)
    new = np.append(True, names[1:] != names[:-1])
    start = np.flatnonzero(new)
    occurrence = np.arange(len(names)) - np.repeat(start, np.diff(start, append=len(names)))
    return stirred(names + occurrence.astype(np.uint64) * np.uint64(STIR[0]))


# Ascending hashes, and up to which hash they are all there.
Sketch = tuple[np.ndarray, int]
WHOLE = 1 << 32


def reduced(names: np.ndarray) -> Sketch:
    """The smallest hashes of a multiset of names."""
    hashes = np.unique((counted(names) >> np.uint64(32)).astype(np.uint32))
    most = max(KEPT, len(hashes) // SHARE)
    return (hashes, WHOLE) if len(hashes) <= most else (hashes[:most], int(hashes[most - 1]))


def sketches(texts: list[str]) -> list[Sketch]:
    """The fingerprint of every text."""
    found = [(np.empty(0, np.uint32), WHOLE)] * len(texts)
    full = [i for i, t in enumerate(texts) if t]
    if not full:
        return found
    lengths = np.array([len(texts[i]) for i in full])
    symbols = np.frombuffer("".join(texts[i] for i in full).encode("utf-32-le"), "<u4").astype(np.uint64)
    first = np.cumsum(lengths) - lengths
    kept: list[list[np.ndarray]] = [[] for _ in full]
    level = 0
    while True:
        level += 1
        symbols, first, repeated, repeated_first = parsed(symbols, first)
        ends, repeated_ends = np.append(first[1:], len(symbols)), np.append(repeated_first[1:], len(repeated))
        if level in LEVELS:
            chosen = range(len(full))
        elif level > max(LEVELS):
            chosen = np.flatnonzero(ends - first >= PHRASES).tolist()
            if not chosen:
                break
        else:
            continue
        for at in chosen:
            kept[at] += symbols[first[at] : ends[at]], repeated[repeated_first[at] : repeated_ends[at]]
    for at, i in enumerate(full):
        found[i] = reduced(np.concatenate(kept[at]))
    return found


def likeness(a: Sketch, b: Sketch) -> float:
    """Share of common names, as far as both fingerprints are whole."""
    bound = min(a[1], b[1])
    one, other = (x[: np.searchsorted(x, bound, side="right")] if bound < WHOLE else x for x, _ in (a, b))
    common = len(np.intersect1d(one, other, assume_unique=True))
    every = len(one) + len(other) - common
    return common / every if every else 1.0


def shown(sketch: Sketch) -> str:
    """Eight hexadecimal digits per name."""
    return sketch[0].astype(">u4").tobytes().hex()


def edited_text(text: str, following: str) -> str:
    """The last third replaced by the start of another text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def in_descending_order(docs: DataFrame) -> DataFrame:
    """(part, doc_id, text): range partitions of descending ids, largest first, in order within each."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash")]
    rows = docs.select("doc_id", text_of().alias("text"), F.xxhash64(text_of()).alias("hash"))
    return (
        rows.repartitionByRange(shuffle_width(docs.sparkSession), *order).sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )


def seams(rows: DataFrame) -> DataFrame:
    """(doc_id, text, following): the last document of every partition with the first text of the next that is not empty."""
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("first", T.StringType()), rows.schema["doc_id"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for batch in batches:
            if batch.num_rows:
                first, last = first or batch.slice(0, 1), batch.slice(batch.num_rows - 1)
        if last is not None:
            yield pa.RecordBatch.from_arrays([last.column("part"), first.column("text"), last.column("doc_id"), last.column("text")], names=schema.names)

    # One row per partition: their number is a setting, not a share of the data.
    ends = rows.mapInArrow(run, schema).repartition("part")
    order = Window.orderBy("part")
    after = ends.select("part").select(
        "part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("next"))
    firsts = ends.select(F.col("part").alias("next"), F.col("first").alias("following"))
    return ends.select("part", "doc_id", "text").join(after, "part").join(firsts, "next").select("doc_id", "text", "following")


FIELDS = [
    T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    ship_package(docs.sparkSession)
    schema = T.StructType([docs.schema["doc_id"], *FIELDS])
    types = [to_arrow_type(f.dataType) for f in schema.fields]
    chunk = CHUNK

    def report(ids: list, texts: list[str], following: str) -> pa.RecordBatch:
        """Rows of consecutive documents; ``following`` is the text after the last."""
        texts = [*texts, following]
        edited = [edited_text(a, b) for a, b in zip(texts, texts[1:])]
        all_sketches = sketches([*texts, *edited])
        own, changed = all_sketches[: len(texts)], all_sketches[len(texts) :]
        columns = [
            ids, [len(t) for t in texts[:-1]], [hashlib.sha256(t.encode()).hexdigest() for t in edited],
            [shown(s) for s in own[:-1]], [shown(s) for s in changed],
            [likeness(a, b) for a, b in zip(own, changed)], [likeness(a, b) for a, b in zip(own, own[1:])],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=schema.names)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All but the last document of a partition."""
        ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if held >= chunk:
                    yield report(ids, texts, text)
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
        if len(ids) > 1:
            yield report(ids[:-1], texts[:-1], texts[-1])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text, following in zip(*(c.to_pylist() for c in batch.columns)):
                yield report([doc_id], [text], following)

    rows = in_descending_order(docs)
    return rows.mapInArrow(within, schema).unionByName(seams(rows).mapInArrow(across, schema))

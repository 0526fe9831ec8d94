"""Quality by the perplexity of an interpolated modified Kneser-Ney model of characters.

The model of a language is trained on its trusted documents. Documents are read
in blocks of one language, packed and compressed; which rows are trusted is
found by a join of ids alone and reaches the texts as one bit per row.
A block's distinct n-grams, numbered, are the rows that meet the model, so that
a common n-gram is a row per block and not one per place. Counts, contexts,
lower orders and queried n-grams are sharded by (lang, n-gram) and joined in
Spark. The probabilities that come back to a block are looked up by number
while its texts are read again. A document stays if its mean negative
log-probability is not above its language's threshold, a high quantile of the
trusted documents' plus a margin, and neither is the share of its n-grams that
stand already shortly before: runs of a likely word are not unlikely to the model.

Defined results: a null language is a language of its own; a document without
characters, or in a language without trusted documents, has no perplexity and
stays; rows with equal ids are separate rows, all trusted if the id is; an empty
table gives an empty result; a very long text is a block of its own, held by one
task; other columns do not matter and may have any names. Where there are too
few n-grams to estimate discounts, the DISCOUNTS are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.keys import boxed, join_facts, text_of, unboxed
from siltstone.session import scratch_path, settle, ship_package, written

ORDER = 4
# Share of a language's trusted documents below the threshold, and what is added to it, in nats per character: their own
# n-grams are in the model, so other good documents lie higher, most of all short ones. The same for the share of repeated n-grams.
QUANTILE, MARGIN, REPEATS_MARGIN = 0.99, 0.25, 0.1
# Characters before an n-gram in which its repetition counts.
WINDOW = 64
# Discounts of counts one, two, and three or more where they cannot be estimated.
DISCOUNTS = (0.5, 1.0, 1.5)
# Rows of a partition whose trust is told in one row of bits.
BITS = 1 << 15
MOST_BITS = 32 << 20
# What stands before a text; characters and rows of a block, and cells of the tables that number its n-grams.
PAD = "\x02"
BLOCK_CHARS = 4 << 20
BLOCK_ROWS = 1 << 15
MOST_CELLS = 1 << 24
# Characters of a block whose wide temporary numbers are held at a time.
SLICE = 1 << 18


def _ranked(codes: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in ascending order, and the place of each code among them."""
    if cells > MOST_CELLS:
        distinct, rank = np.unique(codes), np.empty(len(codes), np.int32)
        for at in range(0, len(codes), SLICE):
            rank[at : at + SLICE] = np.searchsorted(distinct, codes[at : at + SLICE])
        return distinct, rank
    seen = np.zeros(cells, bool)
    seen[codes] = True
    distinct = np.flatnonzero(seen)
    rank = np.empty(cells, np.int32)
    rank[distinct] = np.arange(len(distinct), dtype=np.int32)
    return distinct, rank[codes]


class Grams:
    """The n-grams of several texts: distinct ones, numbered, and the number at every character."""

    def __init__(self, texts: list[str], order: int):
        pad = PAD * (order - 1)
        self.joined = "".join(pad + t for t in texts)
        self.lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(self.lengths + order - 1)
        is_text = np.ones(len(self.joined), bool)
        for back in range(order - 1):
            is_text[ends - self.lengths - 1 - back] = False
        distinct, symbol = _ranked(np.frombuffer(self.joined.encode("utf-32-le"), "<u4"), 0x110000)
        kinds, code = len(distinct), symbol
        for _ in range(1, order):
            # Codes of n-grams that end one place earlier, continued by this place's symbol; those across texts do no harm.
            cells = (int(code.max()) + 1 if len(code) else 1) * kinds
            longer = np.empty(len(code), np.int32 if cells < 1 << 31 else np.int64)
            longer[:1], longer[1:] = code[:1], code[:-1]
            longer *= kinds
            longer += symbol
            code = _ranked(longer, cells)[1]
        longer = symbol = None
        code = code[is_text]
        used, self.number = _ranked(code, int(code.max()) + 1 if len(code) else 1)
        del code
        self.count = len(used)
        place, done = np.empty(self.count, np.int64), 0
        for at in range(0, len(is_text), SLICE):
            at_text = np.flatnonzero(is_text[at : at + SLICE]) + at
            place[self.number[done : done + len(at_text)]] = at_text
            done += len(at_text)
        self.place, self.order = place, order

    def strings(self) -> list[str]:
        """The distinct n-grams by number."""
        return [self.joined[p - self.order + 1 : p + 1] for p in self.place.tolist()]

    def counts(self, weights: np.ndarray) -> np.ndarray:
        """Occurrences by number, each text's as often as its weight."""
        total, each = np.zeros(self.count), np.repeat(weights.astype(np.int32), self.lengths)
        for at in range(0, len(each), SLICE):
            total += np.bincount(self.number[at : at + SLICE], each[at : at + SLICE], self.count)
        return total.astype(np.int64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per text, the sum of its n-grams' values."""
        totals = np.zeros(len(self.number) + 1)
        np.cumsum(values[self.number], out=totals[1:])
        ends = np.cumsum(self.lengths)
        return totals[ends] - totals[ends - self.lengths]

    def repeats(self) -> np.ndarray:
        """Per text, how many of its n-grams stand already among the WINDOW characters before them."""
        order = np.argsort(self.number, kind="stable")
        back = np.diff(order)
        near = (np.diff(self.number[order]) == 0) & (back <= WINDOW)
        place, back = order[1:][near], back[near]
        ends = np.cumsum(self.lengths)
        own = np.searchsorted(ends, place, side="right")
        inside = place - back >= (ends - self.lengths)[own]
        return np.bincount(own[inside], minlength=len(self.lengths))


def _blocks(batches: Iterator[pa.RecordBatch], most_chars: int) -> Iterator[tuple[str, str, pa.Table]]:
    """(name, language, rows) of a task's documents: rows of one language, of bounded size and number."""
    task, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        coded = rows["lang"].combine_chunks().dictionary_encode()
        language = coded.indices.to_numpy(zero_copy_only=False)
        sizes = pa.compute.utf8_length(rows["text"]).to_numpy()
        for code, name in enumerate(coded.dictionary.to_pylist()):
            mine = np.flatnonzero(language == code)
            part = (np.cumsum(sizes[mine]) - sizes[mine]) // most_chars + np.arange(len(mine)) // BLOCK_ROWS
            for p in np.unique(part):
                yield f"{task}-{number}", name, rows.take(pa.array(mine[part == p]))
                number += 1
        pa.default_memory_pool().release_unused()


def digest_of() -> Column:
    """Tells rows with the same id apart."""
    return F.xxhash64(text_of())


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(rows).read_all()


def _ids(trusted: DataFrame) -> DataFrame:
    return trusted.select("doc_id").where("doc_id is not null").distinct()


def marked(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(doc_id, digest, lang, text, trusted).

    Ids are joined without the texts. What comes of it is a bit per row, in
    rows of BITS bits by partition, written once. Up to MOST_BITS bytes of them
    are broadcast to the texts; more are joined by a shuffle, and the result
    written, so that it is the same whenever it is read.
    Like the blocks, it counts on ``docs`` having the same rows in the same
    partitions whenever it is read; ``scores`` makes sure of that.
    """
    place = F.monotonically_increasing_id()
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    task, part, bit = F.shiftright("_place", 33).alias("_task"), F.floor(inside / BITS).alias("_part"), inside % BITS
    found = docs.select("doc_id", place.alias("_place")).join(_ids(trusted), "doc_id", "left_semi")
    bits = written(found.select(task, part, bit.alias("_bit")).groupBy("_task", "_part").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "trusted")
    rows = docs.select(
        "doc_id", digest_of().alias("digest"), F.coalesce("lang", F.lit("")).alias("lang"), text_of().alias("text"), place.alias("_place"))
    rows = rows.select("doc_id", "digest", "lang", "text", task, part, bit.cast("int").alias("_bit"))
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright("_bit", 3) + 1, F.lit(1))), 16, 10).cast("int")
    known = F.expr("shiftright(_byte, _bit % 8) & 1") == 1
    small = bits.count() * BITS // 8 <= MOST_BITS
    told = rows.join(F.broadcast(bits) if small else bits, ["_task", "_part"], "left").withColumn("_byte", byte).select(
        "doc_id", "digest", "lang", "text", F.coalesce(known, F.lit(False)).alias("trusted"))
    return told if small else written(told, "marked")


def block_grams(rows: DataFrame, order: int) -> DataFrame:
    """(block, number, lang, gram, n): a block's distinct n-grams, and how often they occur in trusted texts; written once."""
    most_chars = BLOCK_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, lang, table in _blocks(batches, most_chars):
            grams = Grams(table["text"].to_pylist(), order)
            counts = grams.counts(table["trusted"].to_numpy().astype(np.int64))
            strings = grams.strings()
            for at in range(0, grams.count, 65536):
                part = pa.array(strings[at : at + 65536], pa.string())
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * len(part)), pa.array(np.arange(at, at + len(part), dtype=np.int32)), pa.array([lang] * len(part)),
                    part, pa.array(counts[at : at + len(part)]),
                ], names=["block", "number", "lang", "gram", "n"])

    return written(rows.mapInArrow(run, "block string, number int, lang string, gram string, n long"), "ngrams")


def packed_blocks(rows: DataFrame) -> DataFrame:
    """(block, rows): the same blocks with their rows compressed, as they travel to their n-grams."""
    most_chars = BLOCK_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, table in _blocks(batches, most_chars):
            yield pa.RecordBatch.from_pydict({"block": [block], "rows": [_packed(table)]})

    return rows.mapInArrow(run, "block string, rows binary")


def _tail(gram: Column | str, length: int) -> Column:
    return F.substring(gram, -length, length) if length else F.lit("")


def count_tables(trusted: DataFrame, order: int) -> list[DataFrame]:
    """(lang, gram, c) by order: occurrences of the longest n-grams, below that the number of different characters before."""
    tables = [trusted]
    for n in range(order - 1, 0, -1):
        longer = tables[0]
        tables.insert(0, written(longer.groupBy("lang", _tail("gram", n).alias("gram")).agg(F.count(F.lit(1)).alias("c")), "counts"))
    return tables


def discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3, rows): a row per language, with its number of n-grams."""
    n1, n2, n3, n4 = (F.count_if(F.col("c") == k).cast("double") for k in (1, 2, 3, 4))
    rates = counts.groupBy("lang").agg(n1.alias("n1"), n2.alias("n2"), n3.alias("n3"), n4.alias("n4"), F.count(F.lit(1)).alias("rows"))
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    enough = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)
    found = [k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}") for k in (1, 2, 3)]
    return rates.select("lang", *[
        F.when(enough, F.greatest(F.lit(1e-3), d)).otherwise(F.lit(fixed)).alias(f"d{k}")
        for k, (d, fixed) in enumerate(zip(found, DISCOUNTS), 1)
    ], "rows")


def contexts(counts: DataFrame, n: int) -> DataFrame:
    """(lang, head, total, n1, n2, n3) of n-grams: what follows each context."""
    return counts.groupBy("lang", F.substring("gram", 1, n - 1).alias("head")).agg(
        F.sum("c").alias("total"), *[F.count_if(F.col("c") == k).alias(f"n{k}") for k in (1, 2)], F.count_if(F.col("c") >= 3).alias("n3"))


def probabilities(queried: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """(lang, gram, p) of the queried n-grams of the longest order, in the languages that have a model."""
    order = len(tables)
    kinds = tables[0].groupBy("lang").agg(F.count(F.lit(1)).alias("_kinds"))
    lower = kinds.select("lang", F.lit("").alias("gram"), (1.0 / (F.col("_kinds") + 1)).alias("p"))
    for n in range(1, order + 1):
        counts = tables[n - 1]
        asked = queried.select("lang", _tail("gram", n).alias("gram")).distinct() if n < order else queried
        facts = join_facts(contexts(counts, n), discounts(counts), ["lang"], "rows", counts.count()).select(
            "lang", "head", "total", "d1", "d2", "d3",
            ((F.col("d1") * F.col("n1") + F.col("d2") * F.col("n2") + F.col("d3") * F.col("n3")) / F.col("total")).alias("weight"))
        discount = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        own = F.when(F.col("c").isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.col("c") - discount) / F.col("total"))
        rows = (
            asked.join(counts, ["lang", "gram"], "left")
            .withColumns({"head": F.substring("gram", 1, n - 1), "tail": _tail("gram", n - 1)})
            .join(facts, ["lang", "head"], "left")
            .join(lower.withColumnsRenamed({"gram": "tail", "p": "_lower"}), ["lang", "tail"])
        )
        lower = written(rows.select(
            "lang", "gram", F.when(F.col("total").isNull(), F.col("_lower")).otherwise(own + F.col("weight") * F.col("_lower")).alias("p")), "chances")
    return lower


def scores(docs: DataFrame, trusted: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, digest, lang, trusted, n_chars, surprise, repeats): mean negative log-probability per character, share of repeated n-grams; written once."""
    ship_package(docs.sparkSession)
    rows = marked(docs, trusted)
    grams = block_grams(rows, order)
    known = grams.where("n > 0").groupBy("lang", "gram").agg(F.sum("n").alias("c"))
    tables = count_tables(written(known, "counts"), order)
    found = probabilities(written(grams.select("lang", "gram").distinct(), "asked"), tables)
    # A block of a language without a model keeps its n-grams, without probabilities.
    told = grams.join(found, ["lang", "gram"], "left").select("block", "number", F.log("p").alias("log_p"))
    schema = T.StructType([docs.schema["doc_id"]] + T.StructType.fromDDL(
        "digest long, lang string, trusted boolean, n_chars long, surprise double, repeats double").fields)

    def score(packed: pa.Table, numbers: pa.Table) -> pa.Table:
        table = _unpacked(packed["rows"][0].as_py())
        mine = Grams(table["text"].to_pylist(), order)
        if mine.count != numbers.num_rows:
            raise RuntimeError("a block of documents changed between two reads")
        log_p = np.empty(mine.count)
        log_p[numbers["number"].to_numpy()] = numbers["log_p"].to_numpy()
        with np.errstate(divide="ignore", invalid="ignore"):
            surprise, repeats = -mine.sums(log_p) / mine.lengths, mine.repeats() / mine.lengths
        return pa.table({
            "doc_id": table["doc_id"], "digest": table["digest"], "lang": table["lang"], "trusted": table["trusted"],
            "n_chars": pa.array(mine.lengths), "surprise": pa.array(surprise, mask=~np.isfinite(surprise)),
            "repeats": pa.array(repeats, mask=mine.lengths == 0),
        })

    found = settle(packed_blocks(rows).groupBy("block").cogroup(told.groupBy("block")).applyInArrow(score, schema))
    wrong = found.select("doc_id", "trusted").join(_ids(trusted).withColumn("_known", F.lit(True)), "doc_id", "left").where(
        F.col("trusted") != F.coalesce("_known", F.lit(False)))
    if wrong.limit(1).count():
        raise RuntimeError("the documents changed between two reads")
    return found


def judged(docs: DataFrame, trusted: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, digest, lang, n_chars, perplexity, threshold, kept); the threshold of a repetitive text is 0."""
    found = scores(docs, trusted, order)
    limits = found.groupBy("lang").agg(
        (F.percentile_approx(F.when(F.col("trusted"), F.col("surprise")), QUANTILE, 100_000) + MARGIN).alias("_limit"),
        (F.percentile_approx(F.when(F.col("trusted"), F.col("repeats")), QUANTILE, 100_000) + REPEATS_MARGIN).alias("_most"),
        F.count(F.lit(1)).alias("_rows"))
    repetitive = F.coalesce(F.col("repeats") > F.col("_most"), F.lit(False))
    return join_facts(found, limits, ["lang"], "_rows", found.count()).select(
        "doc_id", "digest", "lang", "n_chars", F.exp("surprise").alias("perplexity"),
        F.when(repetitive, 0.0).otherwise(F.exp("_limit")).alias("threshold"),
        F.coalesce((F.col("surprise") <= F.col("_limit")) & ~repetitive, F.lit(True)).alias("kept"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled as good and not toxic, by every label that they have."""
    return labels.groupBy("doc_id").agg(F.min("quality").alias("_good"), F.max("toxic").alias("_toxic")).where(
        "_good = 1 and _toxic = 0").select("doc_id")


def drop_unlikely(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    gone = judged(docs, trusted).where("not kept").select(F.col("doc_id").alias("_gone_id"), F.col("digest").alias("_gone_digest")).distinct()
    same = F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_digest") == F.col("_gone_digest"))
    return unboxed(boxed(docs, _id=F.col("doc_id"), _digest=digest_of()).join(gone, same, "left_anti"), docs.columns)

"""Hard negatives: rows of another label that score a little below an anchor's positives.

Scores are inner products of whole numbers, and exact. Components are reduced
modulo several small primes; residue matrices are multiplied in float32, whose
sums of products stay below 2^24 and are therefore whole numbers, and the
signed score is put together from its residues by Chinese remaindering. As
many primes are taken as the largest possible score asks for.

Rows and anchors are cut into blocks by a hash, and every block of rows meets
every block of anchors once, in one group. A group keeps each anchor's best
rows of the same label; these are the positives. In a second pass a group
keeps, for every positive, the best rows of other labels within its window of
scores. A group hands over a few rows per anchor, of which the best are taken
over all groups.

Defined results: rows without id, label or vector, or with a component that is
null or not finite, take no part; a shorter vector is filled up with zeros;
rows with equal ids are separate rows (each an anchor of its own, and no row is
its own positive), equal scores and ids are taken in any order, which does not
show; an anchor without positives, or a positive without negatives, has no
rows; an empty table gives an empty result; other columns do not matter, and
there are no texts. Scores beyond 62 bits are an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.vectors import extent, matrix, scaled, sound
from siltstone.session import settle, ship_package, shuffle_width

POSITIVES, NEGATIVES = 5, 5
# A negative's score is between these percentages of its positive's.
WINDOW = (80, 100)
# Float32 holds whole numbers exactly up to this.
EXACT = 1 << 24
# Dimensions whose products are added up before they are reduced.
MOST_DIMS = 256
# Rows and anchors that meet in a group (fewer rows where there would be less groups than tasks), and that are multiplied at a time.
LEAST_BLOCK, ROW_BLOCK, ANCHOR_BLOCK = 1 << 10, 1 << 14, 1 << 14
ROW_STEP, ANCHOR_STEP = 1 << 11, 1 << 9


def moduli(most: int, dims: int) -> list[int]:
    """The largest primes whose sums of ``dims`` products of residues are exact, enough for scores of up to +-``most``."""
    limit = 2 * math.isqrt(EXACT // max(1, dims)) + 1
    found, product = [], 1
    for p in range(limit, 2, -1):
        if product > 2 * most:
            break
        if p % 2 and all(p % d for d in range(3, math.isqrt(p) + 1, 2)):
            found.append(p)
            product *= p
    return found


class Residues:
    """A matrix of whole numbers as one float32 matrix of signed residues per prime, a row per vector."""

    def __init__(self, numbers: np.ndarray, primes: list[int]):
        self.parts = []
        for p in primes:
            r = numbers % p
            self.parts.append(np.where(r > p // 2, r - p, r).astype(np.float32))


def scores(a: Residues, b: Residues, primes: list[int], at: slice, to: slice) -> np.ndarray:
    """Exact inner products of rows ``at`` of a and rows ``to`` of b."""
    total, product = None, 1
    for p, x, y in zip(primes, a.parts, b.parts):
        residue = None
        for d in range(0, x.shape[1], MOST_DIMS):
            part = (x[at, d : d + MOST_DIMS] @ y[to, d : d + MOST_DIMS].T).astype(np.int32) % p
            residue = part if residue is None else (residue + part) % p
        if residue is None:  # vectors without components
            residue = np.zeros((x[at].shape[0], y[to].shape[0]), np.int32)
        if total is None:
            total = residue.astype(np.int64)
        else:
            # The next digit in the mixed base of the primes so far.
            total += product * ((residue - total % p) * pow(product, -1, p) % p)
        product *= p
    total[total > product // 2] -= product
    return total


def _firsts(groups: np.ndarray, most: int) -> np.ndarray:
    """Which of ordered rows are among the first ``most`` of their group."""
    begins = np.ones(len(groups), bool)
    begins[1:] = groups[1:] != groups[:-1]
    starts = np.flatnonzero(begins)
    return np.arange(len(groups)) - np.repeat(starts, np.diff(np.append(starts, len(groups)))) < most


def _best(group: np.ndarray, score: np.ndarray, row: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the best ``most`` of every group: higher scores first, then smaller ids."""
    order = np.lexsort((ids[row], -score, group))
    return order[_firsts(group[order], most)]


def _blocks(vectors: DataFrame, rows: int, per_block: int, name: str, by: str = "row") -> tuple[DataFrame, int]:
    """The vectors with the number of their block, and how many blocks there are."""
    blocks = max(1, -(-rows // per_block))
    return vectors.withColumn(name, F.pmod(F.xxhash64(by), F.lit(blocks)).cast("int")), blocks


def _met(rows: DataFrame, anchors: DataFrame, sizes: tuple[int, int], select: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``select`` of every block of rows with every block of anchors."""
    per_task = -(-sizes[0] // shuffle_width(rows.sparkSession))
    rows, of_rows = _blocks(rows, sizes[0], min(ROW_BLOCK, max(LEAST_BLOCK, per_task)), "_r")
    # New names: both sides come from the same table.
    anchors = anchors.select([F.col(c).alias(f"of_{c}") for c in anchors.columns])
    anchors, of_anchors = _blocks(anchors, sizes[1], ANCHOR_BLOCK, "_a", "of_row")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("_a", every(of_anchors)).groupBy("_r", "_a")
    right = anchors.withColumn("_r", every(of_rows)).groupBy("_r", "_a")
    return left.cogroup(right).applyInArrow(select, schema)


def hard_negatives(
    embeddings: DataFrame, is_anchor: str = "vec_id % 100 = 0", vector: str = "embedding", positives: int = POSITIVES,
    negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, of all rows of vec_id, label and a vector."""
    ship_package(embeddings.sparkSession)
    known = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound(vector))
    vectors = settle(known.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        scaled(vector).alias("numbers"), F.expr(is_anchor).alias("anchor")))
    width, most = extent(vectors, "numbers")
    # By Cauchy and Schwarz no score is above the largest squared length, which width * most ** 2 bounds.
    most = width * most * most
    if most >= 1 << 62:
        raise ArithmeticError("scores of these vectors do not fit 62 bits")
    primes = moduli(most, min(width, MOST_DIMS)) or [3]
    counts = vectors.agg(F.count(F.lit(1)).alias("rows"), F.count_if("anchor").alias("anchors")).first()
    sizes = counts["rows"], counts["anchors"]
    rows = vectors.drop("anchor")
    anchors = vectors.where("anchor").drop("anchor")

    def searched(mine: pa.Table, asked: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """Scores of steps of rows with steps of anchors, which begin at the numbers given."""
        a, b = (Residues(matrix(x, width), primes) for x in (mine["numbers"], asked["of_numbers"]))
        for to in range(0, asked.num_rows, ANCHOR_STEP):
            for at in range(0, mine.num_rows, ROW_STEP):
                yield scores(a, b, primes, slice(at, at + ROW_STEP), slice(to, to + ANCHOR_STEP)), at, to

    def column(t: pa.Table, name: str) -> np.ndarray:
        return t[name].to_numpy()

    def merged(found: list[tuple], held: tuple, ids: np.ndarray, most: int) -> tuple:
        """The best of what is held and of new (group, score, row)."""
        together = tuple(np.concatenate(x) for x in zip(held, *found))
        best = _best(*together, ids, most)
        return tuple(x[best] for x in together)

    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def nearest(mine: pa.Table, asked: pa.Table) -> pa.Table:
        """Per anchor, the best rows of its label but itself."""
        ids, own, label, labels, anchor = column(mine, "vec_id"), column(mine, "row"), column(mine, "label"), column(asked, "of_label"), column(asked, "of_row")
        held = none
        for s, at, to in searched(mine, asked):
            place = slice(at, at + s.shape[0])
            like = (label[place, None] == labels[to : to + s.shape[1]]) & (own[place, None] != anchor[to : to + s.shape[1]])
            r, c = np.nonzero(like)
            held = merged([(c + to, s[r, c], r + at)], held, ids, positives)
        group, score, row = held
        return pa.table({"anchor": anchor[group], "anchor_id": column(asked, "of_vec_id")[group], "id": ids[row], "score": score})

    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    ranked = _met(rows, anchors, sizes, nearest, "anchor long, anchor_id long, id long, score long").withColumn("place", F.row_number().over(best))
    chosen = settle(ranked.where(F.col("place") <= positives).groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("positives")))
    asked_for = anchors.join(chosen.withColumnRenamed("anchor", "row"), "row")
    low, high = window

    def hard(mine: pa.Table, asked: pa.Table) -> pa.Table:
        """Per anchor and positive, the best rows of other labels in the positive's window."""
        ids, label, labels = column(mine, "vec_id"), column(mine, "label"), column(asked, "of_label")
        told = asked["of_positives"].combine_chunks()
        flat, many = told.flatten(), told.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        inside = np.arange(positives) < many[:, None]
        # Windows of scores by anchor and place of the positive, empty ones beyond the last.
        least, last = np.ones((len(many), positives), np.int64), np.zeros((len(many), positives), np.int64)
        wanted = np.zeros((len(many), positives), np.int64)
        positive = flat.field("score").to_numpy(zero_copy_only=False)
        wanted[inside] = positive
        least[inside], last[inside] = -(-low * positive // 100), high * positive // 100
        widest = least.min(axis=1, initial=0, where=inside), last.max(axis=1, initial=0, where=inside)
        held = none
        for s, at, to in searched(mine, asked):
            part = slice(to, to + s.shape[1])
            close = (s >= widest[0][part]) & (s <= widest[1][part]) & (label[at : at + s.shape[0], None] != labels[part])
            r, c = np.nonzero(close)
            score = s[r, c]
            found = []
            for k in range(positives):
                fits = (score >= least[c + to, k]) & (score <= last[c + to, k])
                found.append(((c[fits] + to) * positives + k, score[fits], r[fits] + at))
            held = merged(found, held, ids, negatives)
        group, score, row = held
        at, k = group // positives, group % positives
        ids_of = np.zeros((len(many), positives), np.int64)
        ids_of[inside] = flat.field("id").to_numpy(zero_copy_only=False)
        return pa.table({
            "anchor": column(asked, "of_row")[at], "place": k.astype(np.int32), "anchor_id": column(asked, "of_vec_id")[at], "positive_id": ids_of[at, k],
            "negative_id": ids[row], "positive_score": wanted[at, k], "negative_score": score,
        })

    found = _met(rows, asked_for, sizes, hard, "anchor long, place int, anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

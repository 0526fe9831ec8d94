"""Hard negatives against plain loops, and scores against Python's own numbers."""

import math
import random

import numpy as np
import pytest

from siltstone.llm import negatives
from siltstone.llm.negatives import Residues, hard_negatives, moduli, scores

SCHEMA = "vec_id long, embedding array<double>, label int, row string, _a string, anchor int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def plain(rows, every=10):
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, v, label) in enumerate(kept):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for k, (j, w, other) in enumerate(kept) if k != at)
        for score, j, _ in [x for x in scored if x[2] == label][:5]:
            hard = [(s, n) for s, n, other in scored if other != label and -80 * score <= -100 * s <= -100 * score][:5]
            out += [(i, j, rank, n, -score, -s) for rank, (s, n) in enumerate(hard, 1)]
    return sorted(out)


def vectors(n, dims, seed, spread=0.2, labels=3):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("rows", [
    [],
    [(0, None, 1), (10, [None] * 4, 1), (20, [math.nan] * 4, 1), (30, [math.inf] * 4, 1), (None, [1.0] * 4, 1), (40, [1.0] * 4, None)],
    [(0, [0.5] * 4, 1), (0, [0.5] * 4, 1), (3, [0.5] * 4, 2), (3, [0.5] * 4, 2), (4, [0.45] * 4, 2), (9, [-0.5] * 4, 1)],
    [(10, [], 1), (11, [], 1), (12, [], 2), (20, [0.1, 0.2], 2), (21, [0.3] * 5, 2), (22, [0.2] * 4, 1)],
    [(i, [0.25] * 6, i % 3 // 2) for i in range(200)],
    vectors(300, 8, 1),
    vectors(200, 70, 2, 40.0),
    [(i, v if i % 3 else [0.3] * 5, 0 if i % 3 else label) for i, v, label in vectors(240, 5, 3)],
])
def test_rows_equal_plain_loops(spark, rows):
    found = hard_negatives(frame(spark, rows).repartition(4), "vec_id % 10 = 0")
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == plain(rows)


def test_blocks_do_not_matter(spark, monkeypatch):
    rows = vectors(260, 6, 5)
    for name, size in (("LEAST_BLOCK", 20), ("ROW_BLOCK", 50), ("ANCHOR_BLOCK", 7), ("ROW_STEP", 9), ("ANCHOR_STEP", 4)):
        monkeypatch.setattr(negatives, name, size)
    assert sorted(map(tuple, hard_negatives(frame(spark, rows), "vec_id % 10 = 0").collect())) == plain(rows)


def test_scores_are_exact():
    rng = np.random.default_rng(3)
    for dims, size in ((1, 2), (64, 160), (64, 1 << 20), (300, 1 << 15), (1000, 1 << 25)):
        a, b = (rng.integers(-size, size + 1, (9, dims)) for _ in range(2))
        a[0], b[0] = size, -size
        primes = moduli(dims * size * size, min(dims, negatives.MOST_DIMS))
        found = scores(Residues(a, primes), Residues(b, primes), primes, slice(0, 9), slice(0, 9))
        assert found.tolist() == [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
        assert all(min(dims, negatives.MOST_DIMS) * (p // 2) ** 2 <= negatives.EXACT for p in primes)


def test_scores_that_do_not_fit_are_an_error(spark):
    with pytest.raises(ArithmeticError):
        hard_negatives(frame(spark, [(0, [1e8] * 16, 1)])).collect()

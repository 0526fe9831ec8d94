"""Vector codes against plain loops."""

import hashlib
import math
import random

import numpy as np
import pytest

from siltstone.llm.codes import assign, distinct_parts, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, numbers string, _label string, code int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def plain(rows, parts, entries, rounds):
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    kept = [(i, v + [0] * (parts * width - len(v)), label) for i, v, label in kept]
    first = [v for _, v, _ in sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]))[:entries]]
    cut = lambda v, p: tuple(v[p * width : (p + 1) * width])
    books = [[cut(v, p) for v in first] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            members = {}
            for _, v, _ in kept:
                members.setdefault(nearest(p, cut(v, p))[1], []).append(cut(v, p))
            new.append([tuple(sum(c) // len(members[k]) for c in zip(*members[k])) if k in members else e for k, e in enumerate(books[p])])
        books = new
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], {}
    for i, v, label in kept:
        found = [nearest(p, cut(v, p)) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    return sorted(((i, c, e, by_label[label], digest) for i, c, e, label in out), key=str)


def vectors(n, dims, seed, spread=0.2):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(dims)], rng.choice([None, 0, 1, 1, 1])) for i in range(n)]


@pytest.mark.parametrize("rows, parts, entries", [
    ([], 4, 8),
    ([(1, None, 1), (2, [None] * 8, 1), (3, [math.nan] * 8, 1), (4, [math.inf] + [0.0] * 7, None)], 4, 8),
    ([(None, [0.1] * 8, None), (7, [0.1] * 8, 1), (7, [-0.3] * 8, 2), (7, [0.5] * 8, 2)], 4, 2),
    ([(i, [0.25] * 8, 5) for i in range(500)], 4, 8),
    ([(1, [0.5, -0.5], 1), (2, [0.1] * 7, 1), (3, [], 1)], 4, 8),
    (vectors(700, 8, 1), 4, 16),
    (vectors(400, 6, 2, 0.01), 2, 5),
    ([(i, v if i % 3 else [0.3] * 8, label) for i, v, label in vectors(600, 8, 3)], 4, 8),
])
def test_codes_equal_plain_loops(spark, rows, parts, entries):
    found = vector_codes(frame(spark, rows).repartition(5), parts=parts, entries=entries)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows, parts, entries, 2)


def test_a_trie_walked_in_small_subtrees_gives_the_same():
    rng = np.random.default_rng(5)
    for low, high in ((-3, 4), (-100, 100)):
        parts, place, weight = distinct_parts(rng.integers(low, high, (3000, 4)))
        assert weight.sum() == 3000 and place.max() == len(parts) - 1
        entries = rng.integers(low, high, (17, 4))
        apart = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
        for most in (1, 7, 4096):
            nearest, distance = assign(parts, entries, most)
            assert (nearest == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_sums_that_do_not_fit_are_an_error(spark):
    with pytest.raises(ArithmeticError):
        vector_codes(frame(spark, [(1, [1e8] * 16, 1)])).collect()

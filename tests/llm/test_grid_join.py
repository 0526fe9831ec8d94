"""Near vectors against all pairs."""

import math
import random

import numpy as np
import pytest

from siltstone.llm import grid_join
from siltstone.llm.grid_join import forest, near_vectors

SCHEMA = "vec_id long, embedding array<double>, label int, place string, weight string, h1 int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", 2) for i, v in rows], SCHEMA)


def plain(rows, bound=0.9):
    width = max([len(v) for _, v in rows if v is not None], default=0)
    sound = [v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    units = np.zeros((len(rows), max(1, width)))
    for k, (_, v) in enumerate(rows):
        if sound[k]:
            x = np.array(v) / max(abs(y) for y in v)
            units[k, : len(v)] = x / np.linalg.norm(x)
    near = units @ units.T >= bound
    np.fill_diagonal(near, False)
    out = []
    for k, (i, _) in enumerate(rows):
        reached, todo = {k}, [k]
        while todo:
            for j in np.flatnonzero(near[todo.pop()]).tolist():
                if j not in reached:
                    reached.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in reached if rows[j][0] is not None), default=None)
        out.append((i, int(near[k].sum()), least, i == least))
    return sorted(out, key=str)


def around(n, dims, seed, centres, spread):
    """Vectors near a few centres, others anywhere."""
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(centres)]
    out = []
    for i in range(n):
        v = [rng.gauss(0, 1) for _ in range(dims)] if i % 3 == 0 else [x + rng.gauss(0, spread) for x in rng.choice(middle)]
        out.append((i, [x * rng.choice([1.0, 1e-30, 1e200]) for x in [1.0] for x in v] if i % 50 == 0 else v))
    return out


CHAIN = [(100 - i, [math.cos(i * 0.4), math.sin(i * 0.4)]) for i in range(8)]


@pytest.mark.parametrize("rows", [
    [],
    [(1, None), (2, [0.0, 0.0]), (3, []), (4, [math.nan, 1.0]), (5, [math.inf, 1.0]), (6, [None, 1.0]), (None, None)],
    [(None, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [2.0, 0.1]), (7, [1.0, 0.1, 0.0]), (8, [-1.0, 0.0]), (None, [0.0, -1.0]), (9, [1.0])],
    CHAIN,
    [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [float(i % 7), 1.0, -float(i)]) for i in range(300)],
    around(500, 6, 1, 4, 0.3),
    around(400, 40, 2, 3, 0.25),
])
def test_links_equal_all_pairs(spark, rows):
    found = near_vectors(frame(spark, rows).repartition(5))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows)


@pytest.mark.parametrize("per_block", [7, 40])
def test_blocks_intervals_and_stretches_do_not_matter(spark, monkeypatch, per_block):
    rows = around(420, 5, 3, 4, 0.3) + [(1000 + i, v) for i, v in CHAIN]
    for name, size in (("MOST_ROWS", per_block), ("LEAST_ROWS", 3), ("INTERVAL", 4), ("STRIPE", 3), ("STRETCH", 4)):
        monkeypatch.setattr(grid_join, name, size)
    assert sorted(map(tuple, near_vectors(frame(spark, rows)).collect()), key=str) == plain(rows)


def test_distant_blocks_are_skipped(spark):
    rng = np.random.default_rng(4)
    away = [(k * 100 + i, (np.eye(6)[k % 6] * (1 if k < 6 else -1) + rng.normal(0, 0.02, 6)).tolist()) for k in range(12) for i in range(100)]
    rows = frame(spark, away).selectExpr("vec_id", "embedding as vector", "vec_id as h1", "vec_id as h2", "1L as weight")
    axes = grid_join.principal_axes(rows, 6)
    placed = grid_join.sequence(rows, axes, math.sqrt(0.2)).selectExpr("*", "floor(place / 50) as block")
    pairs = grid_join.near_blocks(placed, 24, axes.shape[1], 0.2)
    assert 24 <= pairs.count() <= 60


def test_forest():
    rng = np.random.default_rng(6)
    for n, links in ((1, 0), (50, 20), (50, 60), (400, 300)):
        a, b = rng.integers(0, n, (2, links))
        label, plainly = forest(a, b, n), np.arange(n)
        for _ in range(n):
            for x, y in zip(a, b):
                plainly[x] = plainly[y] = min(plainly[x], plainly[y])
        assert (label == plainly).all()

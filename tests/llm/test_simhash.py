"""SimHash groups against all pairs, and the Golay keys that find them."""

import random
import re

import numpy as np
import pytest
import xxhash

from siltstone.llm import simhash
from siltstone.llm.components import components
from siltstone.llm.simhash import Golay, drop_near, fingerprint, linked_prints, near_groups, fuzzy_keys


def plain_print(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(nodes, links):
    parent = {n: n for n in nodes}
    links = [(a, b) for a, b in links if a != b]

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_the_code_is_perfect_and_close_words_share_a_key():
    golay = Golay()
    weights = np.bincount(np.bitwise_count(golay.words), minlength=24)
    assert {i: int(n) for i, n in enumerate(weights) if n} == {0: 1, 7: 253, 8: 506, 11: 1288, 12: 1288, 15: 506, 16: 253, 23: 1}
    words = np.arange(2048, dtype=np.uint32) ^ np.uint32(0b1010 << 19)
    own = golay.keys(words)
    assert set((own >= 0).sum(axis=1).tolist()) == {1, 6}
    for i in range(23):
        for j in range(i + 1):
            other = golay.keys(words ^ np.uint32(1 << i) ^ np.uint32(0 if i == j else 1 << j))
            assert ((own[:, :, None] == other[:, None, :]) & (own[:, :, None] >= 0)).any(axis=(1, 2)).all()


def test_any_four_bits_leave_a_common_key():
    rng = random.Random(3)
    golay = Golay()
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        row, key = fuzzy_keys(golay, np.array([a, b], np.uint64).view(np.int64))
        assert set(key[row == 0].tolist()) & set(key[row == 1].tolist())


@pytest.mark.parametrize("text", ["", " \n\t\x0b", "One", "A b C", "a b c d", "ÄÖ \x1c x\x85y \xa0 z w É", "W " * 500, "x" * 70000 + " y z"])
def test_fingerprints(text, monkeypatch):
    monkeypatch.setattr(simhash, "PART", 7)
    assert fingerprint(text) == plain_print(text)


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 180)] + [(7, i) for i in range(200, 900)] + [
        (rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)] + [(5, 5), (-3, 100)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == plain_components(nodes, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("short,long", [(64, 8192), (3, 10)])
def test_links_of_dense_and_random_fingerprints(spark, monkeypatch, short, long):
    monkeypatch.setattr(simhash, "SHORT_RUN", short)
    monkeypatch.setattr(simhash, "LONG_RUN", long)
    rng = random.Random(2)
    prints = {rng.getrandbits(64) for _ in range(300)} | {0, 1, 31, (1 << 64) - 1}
    for centre in list(prints)[:6]:
        for _ in range(120):
            p = centre
            for bit in rng.sample(range(64), rng.randint(1, 6)):
                p ^= 1 << bit
            prints.add(p)
    for p in list(prints)[:40]:  # chains
        for step in range(5):
            for bit in rng.sample(range(64), 4):
                p ^= 1 << bit
            prints.add(p)
    prints = sorted(prints)
    a = np.array(prints, np.uint64)
    close = np.bitwise_count(a[:, None] ^ a[None, :]) <= 4
    signed = a.view(np.int64).tolist()
    expected = plain_components(signed, [(signed[i], signed[j]) for i, j in zip(*np.nonzero(close))])
    got = {r.node: r.label for r in linked_prints(spark.createDataFrame([(p,) for p in signed], "print long"), 4).collect()}
    assert {p: got.get(p, p) for p in signed} == expected


def documents():
    rng = random.Random(9)
    base = [" ".join(rng.choices(["alpha", "Beta", "gamma", "delta", "eps", "zeta", "éta"], k=60)) for _ in range(30)]
    rows = []
    for k, text in enumerate(base):
        for copy in range(1 + (k % 4) * 3 + 40 * (k == 5)):
            words = text.split()
            if copy % 2:
                words[rng.randrange(60)] = f"new{copy}"
            rows.append(" ".join(words))
    rows += [None, "", " ", "one", "one", "One", "two words", "W " * 30000]
    rng.shuffle(rows)
    return [(i, t, "clash", 1) for i, t in enumerate(rows)] + [(3, rows[3], "clash", 1), (3, "other text with id three", "x", 1), (None, "one", "x", 1)]


def test_groups_and_kept_rows(spark):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string, print string, label int").repartition(5)
    prints = [plain_print(t or "") for _, t, *_ in rows]
    label = plain_components(set(prints), [(a, b) for a in set(prints) for b in set(prints) if (a ^ b).bit_count() <= 4])
    least = {}
    for (i, *_), p in zip(rows, prints):
        if i is not None:
            least[label[p]] = min(i, least.get(label[p], i))
    expected = sorted((str(i), f"{p:016x}", least[label[p]]) for (i, *_), p in zip(rows, prints))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in near_groups(df).collect()) == expected
    stay = drop_near(df)
    assert stay.columns == df.columns
    kept = stay.collect()
    assert len(kept) == len(set(label.values()))
    assert sorted(r.doc_id for r in kept) == sorted(least.values())
    assert {label[plain_print(r.text or "")] for r in kept} == set(label.values())


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_groups(df).count() == 0 and drop_near(df).count() == 0

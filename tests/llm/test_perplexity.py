"""Interpolated modified Kneser-Ney against dictionaries, and what it separates on held-out labels."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import perplexity as pp
from siltstone.llm.perplexity import Grams, drop_unlikely, judged, scores, trusted_ids

PAD = pp.PAD


def grams_of(text, order):
    padded = PAD * (order - 1) + text
    return [padded[i : i + order] for i in range(len(text))]


class Plain:
    """A model of one language, from its trusted texts."""

    def __init__(self, texts, order):
        self.order = order
        counts = [Counter() for _ in range(order + 1)]
        for t in texts:
            counts[order].update(grams_of(t, order))
        for n in range(order - 1, 0, -1):
            counts[n].update(g[1:] for g in counts[n + 1])
        self.counts, self.facts = counts, [None] * (order + 1)
        for n in range(1, order + 1):
            rates = [sum(c == k for c in counts[n].values()) for k in (1, 2, 3, 4)]
            if all(rates):
                y = rates[0] / (rates[0] + 2 * rates[1])
                d = [max(1e-3, k - (k + 1) * y * rates[k] / rates[k - 1]) for k in (1, 2, 3)]
            else:
                d = list(pp.DISCOUNTS)
            heads = defaultdict(lambda: [0, 0.0])
            for g, c in counts[n].items():
                heads[g[:-1]][0] += c
                heads[g[:-1]][1] += d[min(c, 3) - 1]
            self.facts[n] = (d, heads)

    def p(self, gram):
        p = 1 / (len(self.counts[1]) + 1)
        for n in range(1, self.order + 1):
            g = gram[-n:]
            d, heads = self.facts[n]
            if g[:-1] in heads:
                total, mass = heads[g[:-1]]
                c = self.counts[n][g]
                p = (max(0.0, c - d[min(c, 3) - 1]) if c else 0.0) / total + mass / total * p
        return p

    def surprise(self, text):
        return -sum(math.log(self.p(g)) for g in grams_of(text, self.order)) / len(text) if text else None


def text(rng, n, signs="abcdefgh éß\U0001f600"):
    return "".join(rng.choices(signs, weights=[2.0 ** -i for i in range(len(signs))], k=n))


def documents():
    rng = random.Random(4)
    rows = [(i, text(rng, rng.randrange(0, 90)), rng.choice(["en", "de", None]), "clash") for i in range(150)]
    rows += [(200, None, "en", "x"), (201, "", "fr", "x"), (202, "no model here", "fr", "x"), (203, "ZZZ\x02\x00QQ", "en", "x"),
             (204, "long " * 3000, "de", "x"), (None, "abab", "en", "x"), (5, "abc", "de", "x"), (5, "abc", "de", "x")]
    labels = [(i, int(i % 3 != 0), int(i % 10 == 1)) for i in range(120)] + [(5, 1, 0), (7, 0, 0), (204, 1, 0), (999, 1, 0), (None, 1, 0)]
    return rows, labels


SCHEMA, LABELS = "doc_id long, text string, lang string, gram string", "doc_id long, quality int, toxic int"


def trusted_of(labels):
    bad = {i for i, q, t in labels if not q or t}
    return {i for i, *_ in labels if i is not None} - bad


@pytest.mark.parametrize("order,chars", [(4, 1 << 20), (2, 100), (1, 1 << 20)])
def test_scores(spark, monkeypatch, order, chars):
    monkeypatch.setattr(pp, "BLOCK_CHARS", chars)
    monkeypatch.setattr(pp, "MOST_BITS", chars)  # small: the bits are joined by a shuffle
    rows, labels = documents()
    good = trusted_of(labels)
    models = {}
    for lang in {r[2] or "" for r in rows}:
        texts = [t or "" for i, t, g, _ in rows if (g or "") == lang and i in good]
        if any(texts):
            models[lang] = Plain(texts, order)
    df = spark.createDataFrame(rows, SCHEMA)
    got = scores(df, trusted_ids(spark.createDataFrame(labels, LABELS)), order).collect()
    expected = sorted(((str(i), g or "", i in good, len(t or ""), models[g or ""].surprise(t or "") if (g or "") in models else None)
                       for i, t, g, _ in rows), key=str)
    found = sorted(((str(r.doc_id), r.lang, r.trusted, r.n_chars, r.surprise) for r in got), key=str)
    assert [f[:4] for f in found] == [e[:4] for e in expected]
    for f, e in zip(found, expected):
        assert (f[4] is None) == (e[4] is None), (f, e)
        assert f[4] is None or math.isclose(f[4], e[4], rel_tol=1e-9), (f, e)


def test_probabilities_of_a_context_sum_to_one():
    rng = random.Random(8)
    model = Plain([text(rng, 200) for _ in range(20)], 3)
    signs = list(model.counts[1])
    for head in ("ab", "zz", PAD * 2):
        total = sum(model.p(head + s) for s in signs) + model.p(head + "一")
        assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_numbering_survives_large_alphabets(monkeypatch):
    texts = ["".join(chr(0x4E00 + (i * k) % 9000) for i in range(500)) for k in range(1, 9)] + ["", "a"]
    plain = Grams(texts, 3)
    monkeypatch.setattr(pp, "MOST_CELLS", 100)
    other = Grams(texts, 3)
    every = Counter(g for t in texts for g in grams_of(t, 3))
    for grams in (plain, other):
        assert Counter(dict(zip(grams.strings(), grams.counts(np.ones(len(texts), int)).tolist()))) == every
    assert (plain.number == other.number).all()


def test_threshold_and_kept_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    trusted = trusted_ids(spark.read.parquet(f"{sf}/labels.parquet"))
    found = judged(docs, trusted).collect()
    assert len(found) == docs.count()
    assert all(r.kept == (r.perplexity is None or r.threshold is None or r.perplexity <= r.threshold) for r in found)
    stay = drop_unlikely(docs, trusted)
    assert stay.columns == docs.columns and stay.count() == sum(r.kept for r in found)


def test_no_documents_or_no_labels(spark):
    empty, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert judged(empty, trusted_ids(labels)).count() == 0
    some = spark.createDataFrame(documents()[0], SCHEMA)
    assert drop_unlikely(some, trusted_ids(labels)).count() == len(documents()[0])


def test_held_out_labels():
    """Trained on half of the labels, the other half keeps its good documents and loses most of its junk."""
    import duckdb

    folder = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"select d.doc_id, d.lang, text, quality from '{folder}/documents.parquet' d join '{folder}/labels.parquet' l using (doc_id) where toxic = 0 and length(text) < 3000").fetchall()
    kept, caught = [], []
    for lang in ("en", "de"):
        mine = [r for r in rows if r[1] == lang]
        train = [r[2] for r in mine if r[3] == 1 and r[0] % 2][:400]
        model = Plain(train, pp.ORDER)
        limit = np.quantile([model.surprise(t) for t in train], pp.QUANTILE) + pp.MARGIN
        test = [r for r in mine if r[0] % 2 == 0][:250]
        kept += [model.surprise(t) <= limit for *_, t, q in test if q == 1 and t]
        caught += [model.surprise(t) > limit for *_, t, q in test if q == 0 and t]
    assert np.mean(kept) > 0.98 and np.mean(caught) > 0.5, (np.mean(kept), np.mean(caught), len(caught))


def test_every_trusted_row_counts(spark):
    """No bound on the trusted rows, and none for a rare language among many."""
    n = 140_000
    docs = spark.range(n).selectExpr("id as doc_id", "if(id % 20000 = 7, 'rare', 'en') as lang", "concat('ab', id % 7) as text")
    found = scores(docs, docs.select("doc_id"), 2).groupBy("lang", "trusted").count().collect()
    assert {(r["lang"], r["trusted"]): r["count"] for r in found} == {("en", True): n - 7, ("rare", True): 7}


def test_repeats_against_a_plain_count():
    rng = random.Random(6)
    texts = [text(rng, n, "ab c") for n in (0, 1, 30, 500)] + ["Der " * 100, "", "no repeats"]
    plain = []
    for t in texts:
        grams = grams_of(t, 3)
        plain.append(sum(g in grams[max(0, i - pp.WINDOW) : i] for i, g in enumerate(grams)))
    assert Grams(texts, 3).repeats().tolist() == plain


def test_runs_of_words_are_caught(spark):
    """By kind of junk, over all labels of sf0.1."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    told = judged(docs, trusted_ids(labels)).join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").where("text <> ''").collect()
    runs = [r.kept for r in told if r.quality == 0 and len(set(r.text.split())) < 0.3 * len(r.text.split())]
    other = [r.kept for r in told if r.quality == 0 and len(set(r.text.split())) >= 0.3 * len(r.text.split())]
    good = [r.kept for r in told if r.quality == 1 and r.toxic == 0]
    print("kept:", [(sum(k), len(k)) for k in (good, runs, other)])
    assert sum(runs) <= 0.01 * len(runs) and sum(other) <= 0.05 * len(other) and sum(good) >= 0.98 * len(good)


def test_documents_that_change_between_reads_are_an_error(spark, monkeypatch):
    docs = spark.range(50).selectExpr("id as doc_id", "'en' as lang", "concat('ab', id) as text")
    assert scores(docs, docs.select("doc_id"), 2).count() == 50
    right = pp.marked
    monkeypatch.setattr(pp, "marked", lambda d, t: right(d, t).withColumn("trusted", F.col("doc_id") < 7))
    with pytest.raises(RuntimeError, match="changed between two reads"):
        scores(docs, docs.select("doc_id"), 2)

"""Exact de-duplication against a dictionary of texts."""

import hashlib
from collections import defaultdict

import pytest

from siltstone.llm.exact_dedup import copy_groups, drop_copies, frequent_winners, digest_table

SCHEMA = "doc_id long, text string, lang string, keep_id string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def expected(rows):
    by_text = defaultdict(list)
    for doc_id, text, *_ in rows:
        by_text[text or ""].append(doc_id)
    out = []
    for text, ids in by_text.items():
        known = [i for i in ids if i is not None]
        keep, marked = (max(known) if known else None), False
        for i in sorted(ids, key=lambda x: (x is None, -(x or 0))):
            kept = i == keep and not marked
            marked |= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [
    [],
    [(1, None, "en", "x"), (2, "", None, None), (3, "a", "en", "x"), (4, "a ", "en", "x")],
    [(None, "a", "en", None), (5, "a", "en", None), (5, "a", "en", None), (None, "b", None, None), (None, "b", None, None)],
    [(i, "hot" if i % 3 == 0 else f"text {i // 2} " * (2000 if i == 7 else 1), "en", None) for i in range(4000)],
])
def test_groups_and_kept_rows(spark, rows):
    df = frame(spark, rows).repartition(7)
    assert sorted(map(tuple, copy_groups(df).collect()), key=str) == expected(rows)
    stay = drop_copies(df)
    assert stay.columns == df.columns
    assert sorted((r.doc_id, r.text or "") for r in stay.collect() if r.doc_id is not None) == sorted(
        {(i, t or "") for i, t, *_ in rows if i is not None and i == max(j for j, u, *_ in rows if (u or "") == (t or "") and j is not None)})
    assert stay.count() == len({t or "" for _, t, *_ in rows})


def test_every_frequent_text_is_found(spark):
    rows = [(i, f"hot {i % 7}" if i % 2 else f"rare {i}", "en", None) for i in range(6000)]
    found = frequent_winners(digest_table(frame(spark, rows).repartition(11)), len(rows)).collect()
    assert {r.keep_id: r.group_size for r in found} == {
        max(i for i in range(6000) if i % 2 and i % 7 == k): sum(1 for i in range(6000) if i % 2 and i % 7 == k) for k in range(7)}

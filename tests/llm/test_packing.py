"""Packing: every token placed once, few sequences, dominated sets fixed."""

import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from siltstone.llm.packing import WordEncoder, best_fit, pack, plan, plan_table, reduce_by_dominance
from siltstone.llm.units import parts_by_size
from siltstone.session import BATCH_BYTES, small_batches

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_bins(pieces, bins, capacity):
    held = Counter()
    for b in bins:
        assert b.count > 0 and b.room == capacity - sum(n * k for n, k in b.holds) >= 0
        for n, k in b.holds:
            held[n] += b.count * k
    assert held == +Counter(pieces)


def fewest(sizes, capacity):
    """The least number of bins, by trying all ways."""
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for r in sorted({*rooms}):
            if r >= sizes[i]:
                at = rooms.index(r)
                place(i + 1, rooms[:at] + [r - sizes[i]] + rooms[at + 1 :])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best[0] if sizes else 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_reduction_never_costs_a_bin(sizes):
    left = Counter(sizes)
    fixed = reduce_by_dominance(left, 20)
    check_bins(Counter(sizes) - +left, fixed, 20)
    rest = sorted((+left).elements(), reverse=True)
    assert sum(b.count for b in fixed) + fewest(rest, 20) == fewest(sorted(sizes, reverse=True), 20)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=64))
def test_plan_places_every_piece(pieces):
    bins = plan(pieces, 64)
    check_bins(pieces, bins, 64)
    total = sum(n * k for n, k in pieces.items())
    least = max(-(-total // 64), sum(k for n, k in pieces.items() if n > 32))
    assert sum(b.count for b in bins) <= least * 1.5 + 1
    assert len(plan_table(bins)["length"]) <= 4 * 64 * 11


def test_best_fit_takes_the_fullest_place():
    bins = best_fit(Counter({6: 1, 5: 1, 4: 1}), 10)
    assert sorted(b.holds for b in bins) == [((5, 1),), ((6, 1), (4, 1))]


LIBRARY = Tokenizer.from_file(PATH)
OWN = WordEncoder(PATH)


def tokens(text):
    return [*LIBRARY.encode(text, add_special_tokens=False).ids, 0]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(
    st.sampled_from([" ", "'", "'s", "'LL", "don't", "<|endoftext|>", "<|STARTOFTEXT|>", ".", "***", "Éa", "E\u0301", "\u0301", "ß", "\u00b5",
                     "A", "word", "İ", "Σ", "\x85", "\xa0", "\n", "12", "ａ", "語", "the"]),
    st.text(st.characters(codec="utf-8"), max_size=3)), max_size=12).map("".join))
def test_ids_are_the_librarys(text):
    assert [x.tolist() for x in OWN.encode(pa.array([text, None, "the " + text]))] == [tokens(t)[:-1] for t in (text, "", "the " + text)]


TEXTS = [None, "", " ", "Hello, world's end\tÉé Ünïcode 12345 !!!", "a<|endoftext|>b <|startoftext|>", "word " * 5000, "x" * 3000,
         "é ́a ΣΑΣ İ \x1c\x85 z", "日本語 テキスト", "short one"] + [f"filler {i} text {'of words ' * (i % 700)}" for i in range(300)]


@pytest.mark.parametrize("capacity", [2048, 64])
def test_rows_against_the_tokenizer(spark, capacity):
    rows = [(i // 2 if i > 300 else i, t, "clash", 1) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, length int").repartition(6)
    got = pack(df, PATH, capacity).collect()
    expected = Counter()
    for i, t, *_ in rows:
        ids = tokens(t or "")
        for p, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], "<u4")
            expected[i, p, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in got)
    assert len(places) <= -(-total // capacity) * 1.02 + 1


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_memory_of_a_batch_is_bounded():
    texts = pa.array(["to be or not to be " * 55] * 24_000)  # 25 MB
    tracemalloc.start()
    tokens_found = sum(len(ids) for a, b in parts_by_size(texts) for ids in OWN.encode(texts.slice(a, b - a)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tokens_found == 24_000 * 55 * 6
    assert peak < 64 << 20


def test_batches_go_to_python_by_their_size(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    texts = spark.range(0, 3000, 1, 1).selectExpr("concat(id, repeat(' word', 1000)) as text")
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    with small_batches(spark):
        found = texts.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in found) == 3000 and max(r["bytes"] for r in found) < BATCH_BYTES + 10_000
    assert spark.conf.get(name) == before

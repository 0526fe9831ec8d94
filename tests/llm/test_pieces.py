"""Prefix-table encoding and decoding against the sentencepiece library."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import pieces
from siltstone.llm.pieces import PieceModel, decode_ids, encode_texts, round_trip

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
OWN = PieceModel(PATH)


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" ▁\tab<0x>éß語\U0001f600\x00the"), st.characters(codec="utf-8")), max_size=60))
def test_ids_and_texts(text):
    for texts in ([text], [text, "", "ab c", text * 2]):
        for t, ids in zip(texts, OWN.encode(pa.array(texts)), strict=True):
            assert ids.tolist() == LIBRARY.encode(t)
            assert OWN.decode(ids) == LIBRARY.decode(ids.tolist())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 260), st.sampled_from([28705, 259, 264])), max_size=9))
def test_any_ids_are_decoded_as_the_library_does(ids):
    assert OWN.decode(np.array(ids, np.int32)) == LIBRARY.decode(ids)


@pytest.mark.parametrize("text", [" " * 1000, " " * 37 + "x", "a" * 5000, "the " * 3000, "ß語" * 3000 + " " * 77])
def test_long_units(text):
    assert OWN.encode(pa.array([text]))[0].tolist() == LIBRARY.encode(text)


def test_generations(monkeypatch):
    monkeypatch.setattr(pieces, "MOST_UNITS", 20)
    model = PieceModel(PATH)
    for k in range(30):
        text = " ".join(f"{'  ' * (i % 3)}word{i * k % 17} über{i}" for i in range(60))
        assert model.encode(pa.array([text]))[0].tolist() == LIBRARY.encode(text)


def test_rows(spark):
    texts = [None, "", " ", "a", "Ünï  ▁x", "é" * 10000, "\U0001f600 ok"] * 3
    df = spark.createDataFrame([(i % 10, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    expected = []
    for i, t in enumerate(texts):
        ids = LIBRARY.encode(t or "")
        expected.append((i % 10, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids) if ids else "")))
    assert sorted(map(tuple, round_trip(df, PATH).collect())) == sorted(expected)
    back = decode_ids(encode_texts(df, PATH), PATH).collect()
    assert sorted((r.doc_id, r.text) for r in back) == sorted((i % 10, (t or "").replace("▁", " ")) for i, t in enumerate(texts))
    assert round_trip(df.limit(0), PATH).count() == 0

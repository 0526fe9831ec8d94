"""The pipeline's rows against the stages done plainly, one after another."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from siltstone.llm import perplexity as pp
from siltstone.llm.queries import WORD_TOKENIZER
from test_perplexity import Plain, trusted_of
from test_secrets import base, mixed, TOKEN
from test_simhash import plain_components, plain_print


def likely(rows, labels):
    good = trusted_of(labels)
    models, limits, most = {}, {}, {}
    for lang in {r["lang"] for r in rows}:
        texts = [r["text"] for r in rows if r["lang"] == lang and r["doc_id"] in good]
        if any(texts):
            models[lang] = Plain(texts, pp.ORDER)
            values = sorted(models[lang].surprise(t) for t in texts if t)
            at = max(0, int(np.ceil(pp.QUANTILE * len(values))) - 1)
            limits[lang] = values[at] + pp.MARGIN
            most[lang] = sorted(repeated(t) for t in texts if t)[at] + pp.REPEATS_MARGIN
    return [r for r in rows if r["lang"] not in models or not r["text"] or (
        models[r["lang"]].surprise(r["text"]) <= limits[r["lang"]] and repeated(r["text"]) <= most[r["lang"]])]


def repeated(text):
    """The share of n-grams that stand already among the characters before them."""
    padded, last, n = pp.PAD * (pp.ORDER - 1) + text, {}, 0
    for i in range(len(text)):
        gram = padded[i : i + pp.ORDER]
        n += i - last.get(gram, -pp.WINDOW - 1) <= pp.WINDOW
        last[gram] = i
    return n / len(text)


def one_of_each(rows, key, pick):
    groups = defaultdict(list)
    for r in rows:
        groups[key(r)].append(r)
    return [pick(g, key=lambda r: r["doc_id"]) for g in groups.values()]


def masked(rows):
    owners, places = defaultdict(set), defaultdict(set)
    spans = {}
    for r in rows:
        mine = base(r["text"])
        mine += [(m.start(), 3, m.end(), m[0]) for m in TOKEN.finditer(r["text"])
                 if mixed(m[0]) and all(m.end() <= s[0] or s[2] <= m.start() for s in mine)]
        spans[r["doc_id"]] = sorted(mine)
        for s in mine:
            owners[s[3]].add(r["source"])
            places[s[3]].add((r["source"], r["doc_id"]))
    out = []
    for r in rows:
        text, end = [], 0
        for a, kind, b, value in spans[r["doc_id"]]:
            if kind == 3 and (len(owners[value]) >= 3 or len(places[value]) >= 20 * len(owners[value])):
                continue
            if a >= end:
                text += [r["text"][end:a], "[secret]"]
            end = max(end, b)
        out.append({**r, "text": "".join(text) + r["text"][end:]})
    return out


@pytest.fixture(scope="module")
def plain(sf):
    con = duckdb.connect()
    rows = [dict(zip(("doc_id", "text", "lang", "source"), r)) for r in con.execute(
        f"select doc_id, coalesce(text, ''), lang, source from '{sf}/documents.parquet'").fetchall()]
    labels = con.execute(f"select doc_id, quality, toxic from '{sf}/labels.parquet'").fetchall()
    steps = [likely(rows, labels)]
    steps.append(one_of_each(steps[-1], lambda r: r["text"], max))
    prints = {r["doc_id"]: plain_print(r["text"]) for r in steps[-1]}
    nodes = set(prints.values())
    label = plain_components(nodes, [(a, b) for a in nodes for b in nodes if (a ^ b).bit_count() <= 4])
    steps.append(one_of_each(steps[-1], lambda r: label[prints[r["doc_id"]]], min))
    steps.append(masked(steps[-1]))
    return rows, steps


def test_every_stage_keeps_what_its_rules_say(spark, sf, plain, tmp_path):
    rows, steps = plain
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for k, ((name, stage), expected) in enumerate(zip(corpus_pipeline.STAGES, steps)):
        out = stage(spark, docs, sf)
        assert out.columns == columns, name
        out.write.parquet(path := str(tmp_path / str(k)))
        docs = spark.read.parquet(path)
        got = Counter((r.doc_id, r.text or "") for r in docs.collect())
        assert got == Counter((r["doc_id"], r["text"]) for r in expected), name
        assert 0 < len(expected) <= len(rows)


def test_run(spark, sf, plain):
    _, steps = plain
    library = Tokenizer.from_file(WORD_TOKENIZER)
    expected = Counter()
    for r in steps[-1]:
        ids = [*library.encode(r["text"], add_special_tokens=False).ids, 0]
        for p, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start : start + 2048], "<u4")
            expected[r["doc_id"], p, start, len(part), zlib.crc32(part.tobytes())] += 1
    got = entry.queries()["pipeline"](spark, sf).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    assert not any(re.search("password=", r["text"]) for r in steps[-1])
    used = defaultdict(int)
    for r in got:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and len(used) <= sum(used.values()) / 2048 * 1.02 + 1


def test_runs_of_repeated_words_go(spark):
    """Of the documents labelled bad, no run of repeated words stays, and the good ones do."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stay = {r.doc_id for r in corpus_pipeline.likely(spark, docs, folder).select("doc_id").collect()}
    labelled = duckdb.sql(f"""select doc_id, quality = 0 or toxic = 1, length(text) > 60 and len(list_distinct(string_split(text, ' '))) <= 0.12 * len(string_split(text, ' '))
        from '{folder}/documents.parquet' join '{folder}/labels.parquet' using (doc_id) where text is not null""").fetchall()
    runs, good = [i for i, bad, run in labelled if bad and run], [i for i, bad, _ in labelled if not bad]
    assert runs and not stay & set(runs)
    assert len(stay & set(good)) >= 0.99 * len(good)


CLASHES = "doc_id long, text string, lang string, source string, n_chars int, _digest string, _place long, _id int, _keep string, _hot int, _text string, parts string, _row string, row int, hits int, block string, rows binary, hash int, label string"


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_columns_of_any_name(spark, sf, stage):
    columns = [c.split()[0] for c in CLASHES.split(", ")]
    rows = [(i, t, "en", "s", len(t or ""), f"d{i}", i, i, "k", 1, "t", "p", "r", i, 7, "b", b"x", i, "l")
            for i, t in enumerate(["plain words stand here", None, "", "plain words stand here", "password=abcdefgh12 and so on", "words"])]
    docs = spark.createDataFrame(rows, CLASHES)
    out = corpus_pipeline.STAGES[stage][1](spark, docs, sf)
    assert out.columns == columns and out.dtypes == docs.dtypes
    got = {r.doc_id: tuple(r) for r in out.collect()}
    for i, row in enumerate(rows):
        if i in got:
            same = [k for k in range(len(columns)) if columns[k] not in ("text", "n_chars")]
            assert [got[i][k] for k in same] == [bytearray(x) if isinstance(x, bytes) else x for x in (row[k] for k in same)]
    assert len(got) >= 3


def test_an_empty_table_and_repeated_null_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for k, rows in enumerate(([], [(None, None, None, None, None)] * 3 + [(1, "a b c", "en", "x", 5), (1, "a b c", "en", "x", 5)])):
        folder = str(tmp_path / str(k))
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        got = corpus_pipeline.run(spark, folder).collect()
        assert sorted((r.doc_id or 0, r.start) for r in got) == ([(0, 0), (1, 0)] if rows else [])

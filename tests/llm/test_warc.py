"""WARC archives: round trips, pushed predicates, skipped payloads, lost attempts."""

import base64
import gzip
import hashlib
import io
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import warc
from siltstone.llm.warc import archive_round_trip, read_records, read_warc, record_bytes, write_archive
from siltstone.session import scratch_path


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(rows, least=0):
    out = Counter()
    firsts, seen = {}, set()
    for i, _, html, *_ in rows:
        if i is not None and len((html or "").encode()) >= least:
            firsts[html or ""] = min(i, firsts.get(html or "", i))
    for i, _, html, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        html = html or ""
        data = html.encode()
        first = len(data) < least or (html not in seen)
        if len(data) >= least:
            seen.add(html)
        out[i, len(data), digest(data), "response" if first else "revisit", None if first else firsts.get(html), True] += 1
    return out


ROWS = [(i, f"http://h/{i}?a=b", f"<p>page {i // 2}</p>\r\n\r\nWARC/1.1\r\n" if i % 3 else "<hot/>", "clash") for i in range(400)] + [
    (1000, None, None, "x"), (1001, "http://e/\r\nX: y", "", "x"), (1002, "http://é/", "é" * 200_000, "x"), (7, "http://h/7?a=b", "<p>page 3</p>\r\n\r\nWARC/1.1\r\n", "x"),
    (None, "http://n/", "<hot/>", "x"), (None, "http://n/", "only null", "x")]
SCHEMA = "page_id long, url string, html string, payload string"


@pytest.mark.parametrize("least", [0, 10])
def test_round_trip(spark, least):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(6)
    got = archive_round_trip(df, least).collect()
    assert Counter(map(tuple, got)) == expected(ROWS, least)


def test_empty_table(spark):
    assert archive_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.fixture(scope="module")
def archive(spark):
    path = scratch_path(spark, "warc-test")
    write_archive(spark.createDataFrame(ROWS, SCHEMA).repartition(4), path)
    return path


def test_header_predicates_are_taken_over(spark, archive):
    df = read_warc(spark, archive, "record_type string, page_id string, target_uri string")
    for test, n in [("record_type = 'revisit'", sum(k[3] == "revisit" for k in expected(ROWS).elements())),
                    ("page_id in ('1', '2', '1002')", 3), ("target_uri is null", 1), ("target_uri like 'http://h/1%'", 111),
                    ("record_type <> 'revisit' and page_id is null", 1)]:
        filtered = df.where(test)
        assert filtered.count() == n, test
        plan = filtered._jdf.queryExecution().executedPlan().toString()
        assert "Filter (" not in plan, plan


def test_payloads_of_unwanted_records_are_not_decoded(monkeypatch):
    data = b"".join(record_bytes(i, f"u{i}", b"x" * 1000, digest(b"x" * 1000), "response", None, "d") for i in range(9))
    decoded = []
    plain = warc._payload
    monkeypatch.setattr(warc, "_payload", lambda *a: decoded.append(1) or plain(*a))
    members = b"".join(gzip.compress(part) for part in [data[:500], data[500:]])
    for file, packed in ((io.BytesIO(data), False), (io.BytesIO(members), True)):
        decoded.clear()
        rows = list(read_records(file, packed, lambda h: h["warc-target-uri"] == "u4", True))
        assert [r["payload"] for r in rows] == [b"x" * 1000] and len(decoded) == 1
        file.seek(0)
        assert len(list(read_records(file, packed, lambda h: True, False))) == 9 and len(decoded) == 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=300), st.booleans()), max_size=6), st.booleans(), st.integers(1, 400))
def test_any_payload_survives(payloads, packed, cut):
    data = b"".join(record_bytes(i, "u", p, digest(p), "response" if keep else "revisit", 0, "d") for i, (p, keep) in enumerate(payloads))
    if packed:
        data = b"".join(gzip.compress(data[i : i + cut]) for i in range(0, len(data), cut))
    rows = list(read_records(io.BytesIO(data), packed, lambda h: True, True))
    assert [r.get("payload") for r in rows] == [p if keep else None for p, keep in payloads]


def test_unlisted_files_are_not_read(spark, archive):
    before = read_warc(spark, archive, warc.HEADERS).count()
    system, path = warc.file_system(archive)
    with system.open_output_stream(f"{path}/part-lost.warc") as f:
        f.write(record_bytes(5, "u", b"x", digest(b"x"), "response", None, "d"))
    assert read_warc(spark, archive, warc.HEADERS).count() == before

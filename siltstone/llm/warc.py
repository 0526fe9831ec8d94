"""WARC archives as a PySpark data source, and archiving pages without repeated payloads.

Reading plans partitions of whole files, takes over predicates on the record
type and on other headers, and reads the headers of a record first. A record
that no predicate wants, or whose payload is not in the requested schema, is
passed over: its block is neither decoded nor, in an archive without outer
compression, read. Give a schema without ``payload`` to read headers only.

Writing is by tasks, each to files of its own name; the driver lists those of
the tasks that succeeded, and readers of a folder with such a list see no
others, so that an attempt that was lost or ran twice leaves no records.
Payloads are compressed inside their record (Content-Encoding), headers stay
plain. Reading also understands archives compressed record by record.

Defined results: a null payload is empty, a null address or id is left out and
read as null; an empty table gives an archive without records; rows with equal
ids are separate records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull, Not,
    StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from siltstone.llm.keys import HOT_SHARE, join_facts
from siltstone.session import scratch_path, settle, ship_package

# Names and formats of the WARC 1.1 standard. The page id is a field of our own.
VERSION = "WARC/1.1"
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_ID, REFERS_TO_PAGE = "WARC-X-Page-ID", "WARC-X-Refers-To-Page-ID"
FIELDS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
    "payload_digest": "warc-payload-digest", "page_id": PAGE_ID.lower(), "refers_to": REFERS_TO_PAGE.lower(),
}
SCHEMA = "record_type string, record_id string, target_uri string, date string, payload_digest string, page_id string, refers_to string, headers map<string,string>, payload binary"

# The list of files of a written archive; bytes from which a writer starts another file, and per partition when reading.
LISTING = "_files.json"
FILE_BYTES = 64 << 20
PARTITION_BYTES = 64 << 20
# Rows, and bytes of payload, of a batch handed to Spark.
BATCH_ROWS, BATCH_BYTES = 2048, 8 << 20


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or address, and the path on it."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder or file)`` and ``df.write.format("warc").save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return WarcReader(self.options["path"], schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"], int(self.options.get("file_bytes", FILE_BYTES)), overwrite)


def wanted(test: Filter, value: str | None) -> bool | None:
    """What a pushed predicate says of a header; None where it cannot be said, which Spark counts as false."""
    if isinstance(test, Not):
        inner = wanted(test.child, value)
        return None if inner is None else not inner
    if isinstance(test, IsNull):
        return value is None
    if isinstance(test, IsNotNull):
        return value is not None
    if isinstance(test, EqualNullSafe):
        return value == test.value
    if value is None:
        return None
    if isinstance(test, EqualTo):
        return value == test.value
    if isinstance(test, In):
        return value in test.value
    if isinstance(test, StringStartsWith):
        return value.startswith(test.value)
    if isinstance(test, StringEndsWith):
        return value.endswith(test.value)
    return test.value in value


TAKEN = (EqualTo, EqualNullSafe, In, IsNull, IsNotNull, StringStartsWith, StringEndsWith, StringContains)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType):
        self.path, self.schema = path, schema
        self.tests: list[tuple[str, Filter]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for test in filters:
            inner = test.child if isinstance(test, Not) else test
            if isinstance(inner, TAKEN) and len(inner.attribute) == 1 and inner.attribute[0] in FIELDS:
                self.tests.append((FIELDS[inner.attribute[0]], test))
            else:
                yield test

    def partitions(self) -> list[Files]:
        """Files, small ones together; only the folder's listing is read here."""
        system, path = file_system(self.path)
        info = system.get_file_info(path)
        if info.type == pafs.FileType.File:
            found = [(path, info.size)]
        else:
            listing = system.get_file_info(f"{path}/{LISTING}")
            if listing.type == pafs.FileType.File:
                with system.open_input_stream(listing.path) as f:
                    names = json.loads(f.read())
                found = [(i.path, i.size) for i in system.get_file_info([f"{path}/{n}" for n in names])]
            else:
                found = [(i.path, i.size) for i in system.get_file_info(pafs.FileSelector(path, recursive=True))
                         if i.path.endswith((".warc", ".warc.gz"))]
        planned: list[Files] = []
        held = PARTITION_BYTES
        for name, size in sorted(found):
            if held + size > PARTITION_BYTES:
                planned.append(Files([]))
                held = 0
            planned[-1].paths.append(name)
            held += size
        return planned or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.path)
        names = self.schema.fieldNames()
        schema = to_arrow_schema(self.schema)
        rows: list[dict] = []
        held = 0
        for path in partition.paths:
            with system.open_input_file(path) as f:
                for row in read_records(io.BufferedReader(f, 1 << 20), path.endswith(".gz"), self.keeps, "payload" in names):
                    rows.append({n: row.get(n) for n in names})
                    held += len(row.get("payload") or b"")
                    if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def keeps(self, headers: dict[str, str]) -> bool:
        return all(wanted(test, headers.get(field)) for field, test in self.tests)


class Members(io.RawIOBase):
    """The inflated bytes of a file of gzip members."""

    def __init__(self, file):
        self.file, self.inflate, self.left = file, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while True:
            if self.inflate.eof:
                self.left, self.inflate = self.inflate.unused_data or self.left, zlib.decompressobj(31)
            source = self.left or self.inflate.unconsumed_tail or self.file.read(1 << 16)
            self.left = b""
            if not source:
                return 0
            data = self.inflate.decompress(source, len(target))
            if data:
                target[: len(data)] = data
                if not self.inflate.eof:
                    self.left = self.inflate.unconsumed_tail
                return len(data)


def _headers(file) -> dict[str, str]:
    """Fields up to the empty line, by lower-cased name."""
    found: dict[str, str] = {}
    name = None
    while line := file.readline().rstrip(b"\r\n"):
        text = line.decode("utf-8", "replace")
        if text[0] in " \t" and name:
            found[name] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            name = name.strip().lower()
            found[name] = value.strip()
    return found


def _pass_over(file, size: int, seekable: bool) -> None:
    if seekable:
        file.seek(size, io.SEEK_CUR)
        return
    while size:
        size -= len(file.read(min(size, 1 << 20))) or size


def read_records(file, compressed: bool, keeps, payloads: bool) -> Iterator[dict]:
    """Records that ``keeps`` accepts by their headers; payloads are decoded only where asked for."""
    if compressed:
        file = io.BufferedReader(Members(file), 1 << 16)
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"a record starts with {line[:40]!r}")
        headers = _headers(file)
        size = int(headers["content-length"])
        if not keeps(headers):
            _pass_over(file, size, not compressed)
            continue
        row = {field: headers.get(name) for field, name in FIELDS.items()} | {"headers": list(headers.items())}
        if payloads and headers.get("warc-type") in ("response", "resource", "conversion"):
            row["payload"] = _payload(file.read(size), headers.get("content-type", ""))
        else:
            _pass_over(file, size, not compressed)
        yield row


def _payload(block: bytes, kind: str) -> bytes:
    """What an HTTP response carries, or the block itself."""
    if not kind.startswith("application/http"):
        return block
    http = io.BytesIO(block)
    http.readline()
    fields = _headers(http)
    body = http.read()
    return gzip.decompress(body) if fields.get("content-encoding") == "gzip" else body


def record_id(row_id: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:' + row_id)}>"


def _clean(value: str) -> str:
    """A header value on one line."""
    return quote(value, safe="".join(map(chr, range(0x20, 0x7F)))) if any(ord(c) < 0x20 for c in value) else value


def record_bytes(page_id, url: str | None, payload: bytes | None, digest: str, kind: str, refers_to, date: str) -> bytes:
    """One record: a response with its payload, or a revisit without."""
    http = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]
    body = b""
    if kind == "response":
        body = gzip.compress(payload or b"", 6, mtime=0)
        http += ["Content-Encoding: gzip", f"Content-Length: {len(body)}"]
    block = "\r\n".join([*http, "", ""]).encode() + body
    head = [
        VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(str(page_id))}", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        head.append(f"{PAGE_ID}: {page_id}")
    if kind == "revisit":
        head += [f"WARC-Profile: {IDENTICAL_PAYLOAD}", f"WARC-Refers-To: {record_id(str(refers_to))}"]
        if refers_to is not None:
            head.append(f"{REFERS_TO_PAGE}: {refers_to}")
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    """Takes rows of (page_id, url, payload, payload_digest, record_type, refers_to, date)."""

    def __init__(self, path: str, file_bytes: int, overwrite: bool):
        self.path, self.file_bytes, self.overwrite = path, file_bytes, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, path = file_system(self.path)
        system.create_dir(path, recursive=True)
        names: list[str] = []
        file = None
        columns = ("page_id", "url", "payload", "payload_digest", "record_type", "refers_to", "date")
        try:
            for batch in iterator:
                for row in zip(*(batch.column(c) for c in columns)):
                    if file is None:
                        names.append(f"part-{uuid.uuid4().hex}.warc")
                        file = system.open_output_stream(f"{path}/{names[-1]}")
                    file.write(record_bytes(*(v.as_py() for v in row)))
                    if file.tell() >= self.file_bytes:
                        file.close()
                        file = None
        finally:
            if file is not None:
                file.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = file_system(self.path)
        system.create_dir(path, recursive=True)
        names = [n for m in messages if m for n in m.names]
        listing = f"{path}/{LISTING}"
        if not self.overwrite and system.get_file_info(listing).type == pafs.FileType.File:
            with system.open_input_stream(listing) as f:
                names = json.loads(f.read()) + names
        with system.open_output_stream(listing) as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Files of an aborted job stay unlisted, which hides them from readers."""


def read_warc(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Records of an archive, with predicates handed to the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    reader = spark.read.format("warc")
    return (reader.schema(schema) if schema else reader).load(path)


def with_roles(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Adds record_type and refers_to: of equal payloads the one with the smallest page_id is the response.

    Payloads that many pages share are settled where they are read, and their
    revisits dropped of the payload there; other pages are shuffled by digest.
    """
    digests = settle(pages.where(F.octet_length("payload") >= least_bytes).select("page_id", "_sha1"))
    limit = max(1, int(digests.count() * HOT_SHARE))
    hot = digests.groupBy("_sha1").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    known = pages.join(F.broadcast(hot.select("_sha1", "_first", F.lit(True).alias("_hot"))), "_sha1", "left")
    small = F.octet_length("payload") < least_bytes
    again = F.coalesce("_hot", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("_first")) & ~small
    by_id = Window.partitionBy("_sha1").orderBy(F.col("page_id").asc_nulls_last())
    columns = [*pages.columns, "record_type", "refers_to"]
    none = F.lit(None).cast(pages.schema["page_id"].dataType)
    parts = [
        known.where(again).withColumns(
            {"payload": F.lit(None).cast("binary"), "record_type": F.lit("revisit"), "refers_to": F.col("_first")}),
        known.where(~again & ~small)
        .withColumns({"_place": F.row_number().over(by_id), "_first": F.first("page_id").over(by_id)})
        .withColumns({"record_type": F.when(F.col("_place") == 1, "response").otherwise("revisit"),
                      "refers_to": F.when(F.col("_place") > 1, F.col("_first"))})
        .withColumn("payload", F.when(F.col("record_type") == "response", F.col("payload"))),
    ]
    if least_bytes > 0:
        parts.append(known.where(small).withColumns({"record_type": F.lit("response"), "refers_to": none}))
    out = parts[0].select(*columns)
    for part in parts[1:]:
        out = out.unionByName(part.select(*columns))
    return out


def write_archive(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """A WARC record per row of (page_id, url, html); of equal payloads all but one are revisits."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("_sha1"))

    @F.arrow_udf("string")
    def base32(digests: pa.Array) -> pa.Array:
        return pa.array([base64.b32encode(bytes.fromhex(d.as_py())).decode() for d in digests], pa.string())

    records = with_roles(rows, least_bytes).withColumns({"payload_digest": base32("_sha1"), "date": F.lit(date)}).drop("_sha1")
    pages.sparkSession.dataSource.register(WarcSource)
    records.write.format("warc").mode("append").save(path)


HEADERS = "record_type string, payload_digest string, page_id string, refers_to string"


def archive_report(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, digest_matches of an archive.

    Size and digest are those of the payloads as read; a revisit has those of
    the response that it refers to. Payloads are read for responses only.
    """
    @F.arrow_udf("string")
    def base32_sha1(payloads: pa.Array) -> pa.Array:
        return pa.array([base64.b32encode(hashlib.sha1(p.as_py() or b"").digest()).decode() for p in payloads], pa.string())

    told = F.regexp_replace("payload_digest", "^sha1:", "")
    responses = settle(
        read_warc(spark, path, f"{HEADERS}, payload binary").where("record_type = 'response'")
        .withColumns({"payload_bytes": F.coalesce(F.octet_length("payload"), F.lit(0)).cast("long"), "_told": told, "payload_digest": base32_sha1("payload")})
        .select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("string").alias("refers_to"), "_told"))
    revisits = settle(read_warc(spark, path, HEADERS).where("record_type = 'revisit'").select(
        "page_id", told.alias("_told"), "record_type", "refers_to"))
    visits = revisits.groupBy("_told").agg(F.count(F.lit(1)).alias("_visits"))
    first = responses.groupBy("payload_digest").agg(F.min("payload_bytes").alias("payload_bytes"))
    facts = first.join(visits, first["payload_digest"] == visits["_told"]).select("_told", "payload_bytes", "payload_digest", "_visits")
    back = join_facts(revisits, facts, ["_told"], "_visits", revisits.count())
    both = responses.unionByName(back.select(*responses.columns))
    return both.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", (F.col("_told") == F.col("payload_digest")).alias("digest_matches"))


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes an archive to the shared folder and reports what reading it back gives; ids have their own type again."""
    spark = pages.sparkSession
    ship_package(spark)
    path = scratch_path(spark, "warc")
    write_archive(pages, path, least_bytes)
    kind = pages.schema["page_id"].dataType
    return archive_report(spark, path).withColumns({"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)})

"""WARC archives as a Python data source for Spark, and de-duplicated writing.

``spark.read.format("warc")`` plans partitions of whole files (small files
together up to ``partition_bytes``), takes equality and ``IN`` predicates on the
record type and the other header columns and size comparisons, parses a record's
headers first, and skips over its block without decoding it where a predicate
fails or the payload is not wanted.  Files named ``.gz`` are read as gzip members.
``df.write.format("warc")`` writes rolled files per task; each commit publishes the
list of its files in ``_commits`` in one step and touches no other commit's list, so
what a lost or repeated task leaves behind is never read, a crash loses no earlier
commit, and two writers keep both of theirs.

Options for reading: ``payload`` (false: leave the column null and skip the
bytes), ``verify`` (true: recompute the payload's digest and fail on mismatch).

Nulls: a null payload is an empty one; a null URI is left out; a null record id
is an error.  Rows that repeat one another, ids included, are records each for
itself.  Header values are one line: a URI with control characters or blanks is
written percent-encoded, with a header that says so, and read back; any other URI,
also of a foreign archive, is kept byte for byte, ``%2F`` and all.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import unquote_to_bytes

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual,
                                    In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage)

from fadeclust.session import fresh_dir, list_dir, read_small_text, write_small_text

from .work import written

FILE_BYTES = 64 << 20
SCHEMA = ("record_type string, record_id string, target_uri string, date string, refers_to string, "
          "payload_digest string, payload_bytes bigint, payload binary")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
            "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
_UNSAFE = re.compile(rb"[\x00-\x20\x7f]")
_ENCODED = re.compile(rb"[\x00-\x20%\x7f]")    # of a URI that holds an unsafe byte
_COMMITS = "_commits"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(row) -> bytes:
    """One record; a revisit bears the response's HTTP headers without its payload."""
    payload = bytes(row.payload or b"")
    if row.record_id is None:
        raise ValueError("a WARC record needs an id")
    size = row.payload_bytes if row.payload_bytes is not None else len(payload)
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size)
    if row.record_type != "revisit":
        block += payload
    digest = row.payload_digest or sha1_base32(payload)
    if len(digest) == 40:  # hexadecimal
        digest = base64.b32encode(bytes.fromhex(digest)).decode()
    head = [b"WARC/1.1", b"WARC-Type: " + row.record_type.encode(), b"WARC-Record-ID: <" + row.record_id.encode() + b">",
            b"WARC-Date: " + (row.date or "1970-01-01T00:00:00Z").encode(), b"WARC-Payload-Digest: sha1:" + digest.encode()]
    if row.target_uri is not None:
        uri = row.target_uri.encode()
        if _UNSAFE.search(uri):
            uri = _ENCODED.sub(lambda m: b"%%%02X" % m[0][0], uri)
            head.append(b"X-Target-URI-Encoding: percent")
        head.append(b"WARC-Target-URI: " + uri)
    if row.refers_to is not None:
        head += [b"WARC-Refers-To: <" + row.refers_to.encode() + b">", b"WARC-Profile: " + _PROFILE.encode()]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


class Files(InputPartition):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths


class Committed(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, int]]) -> None:
        self.files = files


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return WarcWriter(dict(self.options), schema)


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict, schema) -> None:
        self.path = options["path"].rstrip("/")
        self.limit = int(options.get("file_bytes", FILE_BYTES))

    def write(self, iterator) -> Committed:
        fs, base = filesystem(self.path)
        files, out, size, name = [], None, 0, ""
        for row in iterator:
            if out is None:
                fs.create_dir(base, recursive=True)
                name, size = f"part-{uuid.uuid4().hex}.warc", 0
                out = fs.open_output_stream(f"{base}/{name}")
            data = record_bytes(row)
            out.write(data)
            size += len(data)
            if size >= self.limit:
                out.close()
                files.append((name, size))
                out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return Committed(files)

    def commit(self, messages: list) -> None:
        files = sorted(f for m in messages if m is not None for f in m.files)
        write_small_text(self.path, f"{_COMMITS}/{uuid.uuid4().hex}.json", json.dumps(files))

    def abort(self, messages: list) -> None:
        """Files of a failed job are in no commit's list."""


def _committed(path: str) -> list[tuple[str, int]] | None:
    """The files of all commits; None of a folder that this writer did not write."""
    lists = [i.base_name for i in list_dir(f"{path}/{_COMMITS}") if i.base_name.endswith(".json")]
    if not lists:
        return None
    return [tuple(f) for name in lists for f in json.loads(read_small_text(f"{path}/{_COMMITS}/{name}"))]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"].rstrip("/")
        self.partition_bytes = int(options.get("partition_bytes", 16 << 20))
        self.payload = options.get("payload", "true").lower() != "false"
        self.verify = options.get("verify", "false").lower() == "true"
        self.tests: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            if isinstance(f, (EqualTo, In, IsNotNull)) and column in _HEADERS:
                self.tests.append(f)
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and column == "payload_bytes":
                self.tests.append(f)
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        """Committed files (or all archives of a folder without commits), put together by size."""
        fs, base = filesystem(self.path)
        files = _committed(self.path)
        if files is None:
            files = [(i.base_name, i.size) for i in list_dir(self.path) if i.base_name.endswith((".warc", ".warc.gz"))]
        out, size = [[]], 0
        for name, n in sorted(files):
            if out[-1] and size + n > self.partition_bytes:
                out.append([])
                size = 0
            out[-1].append(f"{base}/{name}")
            size += n
        return [Files(p) for p in out]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(self.path)
        rows, size = [], 0
        for path in partition.paths:
            raw = fs.open_input_file(path)
            with io.BufferedReader(gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw, 1 << 20) as f:
                for row in self.records(f):
                    rows.append(row)
                    size += len(row[-1] or b"") + 300
                    if size > 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)

    def records(self, f) -> Iterator[tuple]:
        while True:
            line = f.readline()
            while line in (b"\r\n", b"\n"):
                line = f.readline()
            if not line:
                return
            if not line.startswith(b"WARC/"):
                raise ValueError("not at the start of a WARC record")
            head = _headers(f)
            length = int(head["content-length"])
            digest = head.get("warc-payload-digest")
            row = {"record_type": head.get("warc-type"), "record_id": _bare(head.get("warc-record-id")), "date": head.get("warc-date"),
                   "target_uri": None, "refers_to": _bare(head.get("warc-refers-to")),
                   "payload_digest": digest.partition(":")[2] if digest else None}
            if (uri := head.get("warc-target-uri")) is not None:
                encoded = head.get("x-target-uri-encoding") == "percent"
                row["target_uri"] = unquote_to_bytes(uri).decode("utf-8", "replace") if encoded else uri
            if not all(_holds(t, row) for t in self.tests if t.attribute[0] != "payload_bytes"):
                f.seek(length, io.SEEK_CUR)
                continue
            left, http = length, {}
            if head.get("content-type", "").startswith("application/http"):
                at = f.tell()
                f.readline()
                http = _headers(f)
                left -= f.tell() - at
            full = row["record_type"] != "revisit"
            row["payload_bytes"] = left if full else int(http.get("content-length", 0))
            if not all(_holds(t, row) for t in self.tests if t.attribute[0] == "payload_bytes"):
                f.seek(left, io.SEEK_CUR)
                continue
            payload = None
            if full and (self.payload or self.verify):
                data = f.read(left)
                if len(data) != left:
                    raise ValueError("the archive ends within a record")
                if self.verify and row["payload_digest"] != sha1_base32(data):
                    raise ValueError(f"the payload of {row['record_id']} does not match its digest")
                payload = data if self.payload else None
            else:
                f.seek(left, io.SEEK_CUR)
            yield (row["record_type"], row["record_id"], row["target_uri"], row["date"], row["refers_to"], row["payload_digest"],
                   row["payload_bytes"], payload)


def _headers(f) -> dict[str, str]:
    out = {}
    while (line := f.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.partition(b":")
        out[name.strip().lower().decode("ascii", "replace")] = value.strip().decode("utf-8", "replace")
    return out


def _bare(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def _holds(f: Filter, row: dict) -> bool:
    value = row[f.attribute[0]]
    if isinstance(f, IsNotNull) or value is None:
        return value is not None
    if isinstance(f, In):
        return value in f.value
    return {EqualTo: value.__eq__, GreaterThan: value.__gt__, GreaterThanOrEqual: value.__ge__, LessThan: value.__lt__,
            LessThanOrEqual: value.__le__}[type(f)](f.value)


_ARROW = pa.schema([(c.split()[0], {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in SCHEMA.split(", ")])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Records of pages, equal payloads stored once.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the
    largest id is a response and the others revisit it; rows that repeat that id
    are responses too, and so is every row without an id.  Only digests are
    shuffled; the revisits join the pages by id.
    """
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`").cast("binary"), F.lit(b"")).alias("payload")) \
        .withColumn("digest", F.sha1("payload")).withColumn("n", F.octet_length("payload").cast("long"))
    keys = written(rows.where("id is not null").select("id", "digest", "n"), "digests")
    last = keys.where(F.col("n") >= min_bytes).groupBy("digest", "n").agg(F.max("id").alias("last"), F.min("id").alias("least")) \
        .where("last != least").select("digest", "n", "last")
    revisits = written(keys.join(last, ["digest", "n"]).where("id != last").select(F.col("id").alias("rid"), F.col("digest").alias("rdigest"), "last")
                       .distinct(), "revisits")
    small = 64 * revisits.count() <= 48 << 20
    side = F.broadcast(revisits) if small else revisits.hint("merge")
    joined = rows.join(side, (F.col("id") == F.col("rid")) & (F.col("digest") == F.col("rdigest")), "left")
    again = F.col("last").isNotNull()
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), urn("id").alias("record_id"), F.col("url").alias("target_uri"),
        F.lit("2024-01-01T00:00:00Z").alias("date"), F.when(again, urn("last")).alias("refers_to"),
        F.col("digest").alias("payload_digest"), F.col("n").alias("payload_bytes"), F.when(~again, F.col("payload")).alias("payload"))


def write_pages(pages: DataFrame, path: str | None = None, **columns) -> str:
    """Write pages as archives; returns the folder."""
    spark = pages.sparkSession
    spark.dataSource.register(WarcSource)
    path = path or fresh_dir(spark, "warc")
    page_records(pages, **columns).write.format("warc").mode("append").save(path)
    return path


def read_warc(spark, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(**options).load(path)

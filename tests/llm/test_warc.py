import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from fadeclust.llm.warc import read_warc, write_pages

PAGES = [(1, "http://a/x y\n%41é", "same é"), (2, None, "same é"), (3, "u3", None), (4, "u4", ""), (5, "u5", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n" * 3),
         (6, "u6", "same é"), (6, "u6", "same é"), (7, "u7", "x" * 100_000), (None, "u8", "same é"), (9, "u9", "same é")]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    df = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, digest string").repartition(3)
    return write_pages(df, str(tmp_path_factory.mktemp("warc") / "a"))


def test_round_trip(spark, archive):
    rows = read_warc(spark, archive, verify="true").collect()
    assert len(rows) == len(PAGES)
    want = {}
    for i, u, h in PAGES:
        p = (h or "").encode()
        last = max((j for j, _, g in PAGES if (g or "") == (h or "") and j is not None), default=None)
        revisit = i is not None and i != last
        want.setdefault(f"urn:page:{'' if i is None else i}", []).append((
            u, "revisit" if revisit else "response", f"urn:page:{last}" if revisit else None,
            base64.b32encode(hashlib.sha1(p).digest()).decode(), len(p), None if revisit else p))
    got = {}
    for r in rows:
        got.setdefault(r.record_id, []).append((r.target_uri, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes,
                                                None if r.payload is None else bytes(r.payload)))
    assert got == want


def test_pushdown_and_skipped_payloads(spark, archive):
    df = read_warc(spark, archive, payload="false")
    assert df.where("payload is not null").count() == 0
    some = df.where("record_type = 'revisit' and payload_bytes > 3 and target_uri is not null")
    assert {r.record_id for r in some.collect()} == {"urn:page:1", "urn:page:6"}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "record_type = revisit" not in plan.split("BatchScan")[0]
    assert df.where(F.col("record_id").isin("urn:page:7", "urn:page:3")).count() == 2


def test_files_outside_the_manifest_are_not_read(spark, archive):
    with open(f"{archive}/part-stray.warc", "wb") as f:
        f.write(b"WARC/1.1\r\nWARC-Type: resp")
    assert read_warc(spark, archive).count() == len(PAGES)


def test_min_bytes_and_empty(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    path = write_pages(df, str(tmp_path / "b"), min_bytes=1000)
    assert read_warc(spark, path).where("record_type = 'revisit'").count() == 0
    path = write_pages(df.limit(0), str(tmp_path / "c"))
    assert read_warc(spark, path).count() == 0


def test_damaged_archive_fails(spark, tmp_path):
    path = write_pages(spark.createDataFrame(PAGES[:1], "page_id long, url string, html string"), str(tmp_path / "d"))
    import glob
    name = glob.glob(f"{path}/part-*.warc")[0]
    data = open(name, "rb").read()
    open(name, "wb").write(data.replace(b"same", b"sane"))
    with pytest.raises(Exception, match="does not match"):
        read_warc(spark, path, verify="true").collect()


def foreign(uri, body):
    block = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n" + body
    head = (b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:%d>\r\nWARC-Target-URI: %s\r\nContent-Type: application/http; msgtype=response\r\n"
            b"WARC-Payload-Digest: sha1:%s\r\nContent-Length: %d\r\n\r\n") % (len(body), uri, base64.b32encode(hashlib.sha1(body).digest()), len(block))
    return head + block + b"\r\n\r\n"


def test_foreign_archives_gzip_and_uris(spark, tmp_path):
    import gzip
    records = [foreign(b"http://x/a%2Fb?q=%26c", b"one"), foreign("http://x/é%41".encode(), b"three"), foreign(b"http://x/plain", b"payload " * 50_000)]
    folder = tmp_path / "foreign"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records[:2]))       # a member per record
    (folder / "b.warc").write_bytes(records[2])
    (folder / "c.txt").write_bytes(b"no archive")
    rows = {r.target_uri: bytes(r.payload) for r in read_warc(spark, str(folder), verify="true").collect()}
    assert rows == {"http://x/a%2Fb?q=%26c": b"one", "http://x/é%41": b"three", "http://x/plain": b"payload " * 50_000}
    assert read_warc(spark, str(folder), payload="false").where("target_uri = 'http://x/a%2Fb?q=%26c'").count() == 1


def test_commits_do_not_touch_one_another(spark, tmp_path):
    from fadeclust.llm.warc import Committed, WarcWriter
    path = write_pages(spark.createDataFrame([(1, "u", "a")], "page_id long, url string, html string"), str(tmp_path / "e"))
    write_pages(spark.createDataFrame([(2, "v", "b")], "page_id long, url string, html string"), path)
    assert sorted(r.record_id for r in read_warc(spark, path).collect()) == ["urn:page:1", "urn:page:2"]
    (tmp_path / "e" / "part-x.warc").write_bytes(foreign(b"http://x", b"x"))
    one, two = (WarcWriter({"path": path}, None) for _ in range(2))     # two jobs that end at once
    one.commit([Committed([("part-x.warc", 10)]), None])
    two.commit([])
    assert read_warc(spark, path).count() == 3

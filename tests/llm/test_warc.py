"""WARC archives: round trips, version lines inside payloads, splits."""

import base64
import glob
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from textloom.llm import warc

FAKE = (
    "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nfake!\r\n\r\n"
)
TRAP = "x WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + "y" * 30
PAGES = [
    (1, "http://a/1", "<html>é</html>"),
    (2, "http://a/2", "<html>é</html>"),
    (3, None, "<html>é</html>"),
    (4, "http://a/4\r\nX: y", None),
    (5, "http://a/5", ""),
    (6, "http://a/6", "before " + FAKE + FAKE + " after"),
    (7, "http://a/7", FAKE),
    (8, "http://a/8", "WARC/1.1\r\n"),
    (9, "http://a/9", "z" * 200_000 + TRAP + "\r\n\r\n"),
    (10, "http://a/10", "WARC/1.1\r\nContent-Length: 99999999999999999999999\r\n\r\n"),
    (11, "http://a/11", "end WARC/1.1\r\nContent-Length: 0"),
    (None, "http://a/n", "<html>é</html>"),
    (12, "http://a/12", "only one"),
    (12, "http://a/12", "only one"),
]


def want(rows, least):
    largest = {}
    for page, _, html in rows:
        html = html or ""
        if page is not None:
            largest[html] = max(largest.get(html, page), page)
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        keeper = largest[html or ""] if len(raw) >= least else page
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        revisit = page != keeper
        out.append((page, len(raw), digest, "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=repr)


def got(spark, folder):
    found = warc.read_archives(spark, folder)
    assert found.filter("not intact").count() == 0
    rows = found.select(
        warc.page_number(F.col("record_id")), "payload_bytes", "payload_digest", "record_type",
        warc.page_number(F.col("refers_to")),
    ).collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(p, u, h, "x", 1) for p, u, h in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, sha1 string, keeper int")


@pytest.mark.parametrize("least,compression,parts", [(0, "gzip", 3), (0, "none", 1), (20, "none", 2)])
def test_round_trip(spark, pages, least, compression, parts):
    folder = warc.write_archives(pages.repartition(parts), revisit_from=least, compression=compression)
    assert got(spark, folder) == want(PAGES, least)


def test_small_splits(spark, pages):
    """Records and version lines that span splits of the file."""
    many = pages.union(pages.withColumn("page_id", F.col("page_id") + 100)).coalesce(1)
    folder = warc.write_archives(many, revisit_from=10**9, compression="none")
    rows = PAGES + [(None if p is None else p + 100, u, h) for p, u, h in PAGES]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (700, 4096):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert got(spark, folder) == want(rows, 10**9)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_bytes_are_a_warc_file(spark, pages):
    folder = warc.write_archives(pages.filter("page_id = 6"), compression="gzip")
    raw = b"".join(gzip.open(f).read() for f in glob.glob(folder.removeprefix("file:") + "/part-*"))
    head, rest = raw.split(b"\r\n\r\n", 1)
    length = int([x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")][0].split(b":")[1])
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response") and rest[length:] == b"\r\n\r\n"
    assert rest[:length].split(b"\r\n\r\n", 1)[1].decode() == PAGES[5][2]


def test_foreign_and_cut_files(spark, tmp_path):
    ok = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 4\r\n\r\nHTTP\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(("junk " + ok).encode())
    (tmp_path / "b.warc").write_bytes((ok + ok[:-6]).encode())
    (tmp_path / "c.warc").write_bytes(b"")
    found = warc.read_archives(spark, str(tmp_path)).collect()
    assert [r.record_id for r in found] == ["<urn:page:1>"]


def test_empty_table(spark, pages):
    folder = warc.write_archives(pages.limit(0))
    assert warc.read_archives(spark, folder).count() == 0


def _archive(version, bodies):
    head = "{}\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\nWARC-Payload-Digest: sha1:{}\r\nContent-Length: {}\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\n\r\n"
    out = b""
    for k, body in enumerate(bodies):
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out += head.format(version, k, digest, len(http) + len(body)).encode() + http + body + b"\r\n\r\n"
    return out


def test_both_versions_are_read(spark, tmp_path):
    bodies = [b"one", b"WARC/1.0\r\nContent-Length: 1\r\n\r\nx\r\n\r\nWARC/1.", b"WARC/1.1\r\n", b"last"]
    for version in ("WARC/1.0", "WARC/1.1"):
        (tmp_path / version.replace("/", "")).write_bytes(_archive(version, bodies))
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(r.payload_bytes for r in rows) == sorted(2 * [len(b) for b in bodies])
    assert all(r.intact for r in rows)


@pytest.mark.parametrize("version", ["WARC/0.18", "WARC/1.2"])
def test_unknown_version_is_an_error(spark, tmp_path, version):
    (tmp_path / "x.warc").write_bytes(_archive(version, [b"one"]))
    with pytest.raises(ValueError, match="unknown version"):
        warc.read_archives(spark, str(tmp_path)).count()

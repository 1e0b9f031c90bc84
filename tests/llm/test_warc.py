"""WARC archives: round trips, predicates inside the scan, payloads that are not decoded, files of other writers."""

from __future__ import annotations

import gzip
import hashlib
import io
import os
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, Not, StringStartsWith

from reelspan.llm import queries, warc
from tests.llm.test_operators import SF

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("original", T.StringType()), T.StructField("a.b", T.StringType()), T.StructField("warc_type", T.StringType()), T.StructField("sha256", T.StringType())])
LONG = "ä" * 700


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "o", "k", "t", "s") for i, u, h in rows], PAGES)


def brute(rows):
    """From the contract: (page_id, bytes, sha1, type, refers_to)."""
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        ids = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        best = max(ids) if ids and len(b) >= 1000 else None
        again = best is not None and (i is None or i < best)
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", best if again else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a/1", LONG), (2, "http://a/2", LONG), (9, None, LONG), (9, None, LONG), (None, "http://a/n", LONG), (3, "http://b/\r\nX: y", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""),
    (7, "u", "x" * 999), (8, "u", "x" * 999), (10, "u", "y" * 1000), (11, "u", "y" * 1000), (12, "u", "line\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40), (None, "u", "z" * 2000), (None, "u", "z" * 2000), (13, "u", "long " * 1_000_000),
]


def test_round_trip(spark, tmp_path):
    warc.archive_pages(pages(spark, ROWS).repartition(3), str(tmp_path / "w"))
    got = sorted((tuple(r) for r in warc.pages_of(spark, str(tmp_path / "w")).collect()), key=repr)
    assert got == brute(ROWS)
    assert not [x for x in os.listdir(tmp_path / "w") if not x.endswith(".warc.gz") and not x.startswith(".")]
    texts = warc.read(spark, str(tmp_path / "w"), "record_id string, warc_type string, payload binary, target_uri string").filter("warc_type = 'response'").collect()
    assert sorted(bytes(r.payload).decode() for r in texts if r.record_id == "<urn:page:12>") == [ROWS[13][2]]
    assert [r.target_uri for r in texts if r.record_id == "<urn:page:3>"] == ["http://b/%0D%0AX: y"]


def test_empty_table(spark, tmp_path):
    warc.archive_pages(pages(spark, []), str(tmp_path / "w"))
    assert warc.pages_of(spark, str(tmp_path / "w")).collect() == []


def test_overwrite_and_append(spark, tmp_path):
    df = spark.range(4).select(F.format_string("<urn:x:%d>", "id").alias("record_id"), F.lit(b"abc").alias("payload"))
    for mode, n in (("append", 4), ("append", 8), ("overwrite", 4)):
        warc.write(df, str(tmp_path / "w"), mode, rollBytes=500)
        assert warc.read(spark, str(tmp_path / "w")).filter("warc_type = 'response'").count() == n


def test_predicates_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.archive_pages(pages(spark, ROWS), path)
    df = warc.read(spark, path, pushdown=True).filter("warc_type = 'revisit' and record_id like '<urn:page:1>%' and http_status = 200")
    assert [r.record_id for r in df.collect()] == ["<urn:page:1>"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "Filter [" not in plan
    every = warc.read(spark, path).collect()
    everything = spark.createDataFrame(every, warc.SCHEMA)
    for condition in ("payload_length > 1000", "target_uri is null and warc_type = 'response'", "not warc_type = 'response'", "warc_type in ('revisit', 'x') or content_length < 100", "refers_to <=> null", "payload_digest = '%s'" % hashlib.sha1(LONG.encode()).hexdigest()):
        kept = [str(r.record_id) for r in warc.read(spark, path, pushdown=True).filter(condition).collect()]
        assert sorted(kept) == sorted(str(r.record_id) for r in everything.filter(condition).collect()) and kept


def test_predicates_of_a_load_are_its_own(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.archive_pages(pages(spark, ROWS), path)
    n = len(ROWS)
    again = warc.read(spark, path, where=[("warc_type", "=", "revisit"), ("http_status", "in", [200, 304]), ("target_uri", "not null")])
    every = warc.read(spark, path, where=[("warc_type", "not =", "warcinfo")])
    revisits = len([r for r in brute(ROWS) if r[3] == "revisit" and r[0]]) + 1
    assert again.count() == revisits and every.count() == n
    assert every.filter("warc_type = 'revisit'").unionByName(every).unionByName(again).count() == n + 2 * revisits
    with pytest.raises(Exception, match="can't judge"):
        warc.read(spark, path, where=[("payload", "=", "x")]).count()


def archive(n=50, size=40_000):
    """Records of incompressible payloads, with and without stated lengths."""
    stated, bare, flat = b"", b"", b""
    for i in range(n):
        body = hashlib.shake_256(str(i).encode()).digest(size)
        one = warc.record_of({"record_id": f"<urn:x:{i}>", "warc_type": "resource" if i % 5 else "response", "payload": body}, "2024-01-01T00:00:00Z")
        stated, bare, flat = stated + warc._member(one, 1), bare + gzip.compress(one, 1), flat + one
    return stated, bare, flat, gzip.compress(flat, 1)


@pytest.mark.parametrize("kind", range(4))
def test_unwanted_payloads_are_not_inflated(kind):
    data = archive()[kind]
    source = warc.Inflated(io.BytesIO(data))
    got = list(warc.records(source, [EqualTo(("warc_type",), "response")], True))
    assert [r["record_id"] for r in got] == [f"<urn:x:{i}>" for i in range(0, 50, 5)]
    assert [r["payload"] for r in got] == [hashlib.shake_256(str(i).encode()).digest(40_000) for i in range(0, 50, 5)]
    if kind == 0:
        assert source.inflated < 13 * 42_000  # ten payloads and the headers of all
    places = [r["offset"] for r in warc.records(warc.Inflated(io.BytesIO(data)), [], False)]
    assert len(places) == 50 and (kind == 3 or all(data[p : p + 2] in (b"\x1f\x8b", b"WA") for p in places))


def test_files_of_other_writers():
    http = b"HTTP/1.0 404 Not Found\r\nX-Long: a\r\n b\r\nTransfer-Encoding: chunked\r\nContent-Encoding: gzip\r\n\r\n"
    packed = gzip.compress(b"hello")
    body = http + b"%x;x=1\r\n" % len(packed) + packed + b"\r\n0\r\n\r\n"
    one = b"WARC/1.0\nwarc-type: response\nContent-Type: application/http\nWARC-Payload-Digest: sha1:%s\nContent-Length: %d\n\n" % (b"A" * 32, len(body)) + body + b"\r\n\r\n"
    two = b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    a, b = warc.records(warc.Inflated(io.BytesIO(one + b"\r\n" + two)), [], True)
    assert (a["payload"], a["http_status"], a["payload_digest"]) == (b"hello", 404, "00" * 20)
    assert (b["payload"], b["payload_length"], b.get("http_status")) == (b"abc", 3, None)
    for bad in (one[:-30], gzip.compress(one)[:-20], b"junk\r\n" + two, b"WARC/1.0\r\nWARC-Type: x\r\n\r\n", zlib.compress(one)):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.records(warc.Inflated(io.BytesIO(bad)), [], True))


def test_predicates_on_nulls():
    row = {"warc_type": "response", "http_status": None}
    assert warc.passes(Not(EqualTo(("warc_type",), "x")), row) and not warc.passes(Not(EqualTo(("http_status",), 200)), row) and not warc.passes(GreaterThan(("http_status",), 1), row)
    assert warc.passes(In(("warc_type",), ("response",)), row) and not warc.passes(IsNotNull(("http_status",)), row) and warc.passes(StringStartsWith(("warc_type",), "resp"), row)


def test_partitions(spark, tmp_path):
    df = spark.range(40, numPartitions=4).select(F.format_string("<urn:x:%d>", "id").alias("record_id"), F.expr("cast(repeat(uuid(), 50) as binary)").alias("payload"))
    warc.write(df, str(tmp_path / "w"), rollBytes=800)
    small = warc.read(spark, str(tmp_path / "w"), partitionBytes=1200)
    assert small.rdd.getNumPartitions() > 4 and small.filter("warc_type = 'response'").count() == 40
    one = next(str(p) for p in sorted((tmp_path / "w").iterdir()) if p.name.endswith(".gz"))
    assert warc.read(spark, str(tmp_path / "w"), where=[("path", "=", one)], partitionBytes=1).rdd.getNumPartitions() == 1
    (tmp_path / "w" / "z.warc").write_bytes(b"WARC/1.0\r\nContent-Length: 5\r\n\r\nab")
    with pytest.raises(Exception, match="cut off"):
        warc.read(spark, str(tmp_path / "w")).count()
    assert warc.read(spark, str(tmp_path / "w"), corrupt="stop").filter("warc_type = 'response'").count() == 40


def test_registered_query(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op11_warc(spark, SF).collect()), key=repr) == brute(rows)

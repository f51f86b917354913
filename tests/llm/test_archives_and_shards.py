"""WARC archives and shards."""

import gzip
import hashlib
import zlib

import numpy as np
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from veilrank.llm import sharding, warc
from veilrank.session import scratch_path

PAGES = [
    (3, "http://a/", "<p>" + "x" * 200), (1, "http://b/\r\nX: y", "<p>" + "x" * 200),
    (2, None, "<p>" + "x" * 200), (4, "http://c/", "short"), (5, "http://d/", "short"),
    (6, "http://é/", None), (7, "http://e/", ""), (None, "http://f/", "<p>" + "x" * 200),
    (8, "http://g/", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 20), (9, "u", "é" * 50), (10, "u", "é" * 50),
    (11, "u", "q" * 300_000), (1, "http://b/", "<p>" + "x" * 200),
]


@pytest.fixture(scope="module")
def archive(spark):
    path = scratch_path(spark, "warc")
    rows = [(*r, "clash") for r in PAGES]
    warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string, payload string"), path)
    return path


def test_pages_come_back(spark, archive):
    got = sorted(map(tuple, warc.read_pages(spark, archive).collect()), key=repr)
    first = defaultdict(list)
    for key, _, html in PAGES:
        if key is not None:
            first[html or ""].append(key)
    want = []
    for key, _, html in PAGES:
        body = (html or "").encode()
        least = min(first[html or ""])
        again = len(body) >= 100 and key != least
        want.append((key, len(body), hashlib.sha256(body).hexdigest(),
                     "revisit" if again else "response", least if again else None))
    assert got == sorted(want, key=repr)


def test_predicates_reach_the_reader_and_headers_are_safe(spark, archive):
    df = warc.read_warc(spark, archive, payload=False).where(
        "record_type = 'revisit' AND target_uri LIKE 'http%' AND payload_length > 10"
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan
    rows = df.collect()
    assert {warc_row.record_id for warc_row in rows} == {"<urn:page:3>", "<urn:page:>"}
    assert all(r.payload is None and r.payload_length == 203 for r in rows)
    uris = {r.target_uri for r in warc.read_warc(spark, archive).where("record_type = 'response'").collect()}
    assert "http://b/%0D%0AX: y" in uris and "http://é/" in uris


def test_negated_and_null_filters(spark, archive):
    records = warc.read_warc(spark, archive, payload=False).where("record_type <> 'warcinfo'")
    assert records.count() == len(PAGES)
    assert records.where("target_uri IS NULL").count() == 1
    assert records.where("target_uri NOT IN ('u')").count() == len(PAGES) - 1 - 3


def foreign_record(kind, body, name):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {name}\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("packed", [True, False])
def test_archives_of_others(spark, tmp_path, packed):
    http = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nhello\r\n\r\nWARC/1.0"
    records = [foreign_record("resource", b"z" * 5000, "<a>"), foreign_record("metadata", b"", "<b>"),
               foreign_record("response", http, "<c>").replace(
                   b"WARC-Type", b"Content-Type: application/http\r\nWARC-Type")]
    if packed:
        (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    else:
        (tmp_path / "x.warc").write_bytes(b"".join(records))
    (tmp_path / "other.txt").write_text("not an archive")
    rows = {r.record_id: r for r in warc.read_warc(spark, str(tmp_path)).collect()}
    assert bytes(rows["<a>"].payload) == b"z" * 5000 and rows["<b>"].payload_length == 0
    assert bytes(rows["<c>"].payload) == b"hello\r\n\r\nWARC/1.0"
    assert [r.record_id for r in warc.read_warc(spark, str(tmp_path)).where("record_type='metadata'").collect()] == ["<b>"]


def test_no_pages(spark):
    path = scratch_path(spark, "warc")
    warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_pages(spark, path).count() == 0


def check_shards(rows, n, most):
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r)
    assert set(shards) <= set(range(n))
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    total = sum(r["size"] for r in rows)
    for s in range(n):
        assert abs(sum(r["size"] for r in shards[s]) - total / n) <= most
    return shards


def test_shards_are_even_and_gapless_with_a_hot_text(spark, monkeypatch):
    monkeypatch.setattr(sharding, "TASK_BYTES", 2_000)  # many inner boundaries
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "the same text for a third of all rows")
        .otherwise(F.concat(F.lit("text "), F.md5(F.col("id").cast("string")))).alias("text"),
        F.lit(1).alias("size"),
    )
    rows = sharding.shard(docs, 7).collect()
    assert len(rows) == 3000
    assert {r.doc_id for r in rows} == set(range(3000))
    check_shards(rows, 7, 0.02 * 3000 * 53 / 7 + 2 * 53)
    for r in rows[:50]:
        assert r["size"] == len(r.text) + 16 and r.text_crc32 == zlib.crc32(r.text.encode())


def test_equal_texts_stay_together_where_they_can(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.md5((F.col("id") % 1000).cast("string")).alias("text")
    )
    rows = sharding.shard(docs, 4).collect()
    where = defaultdict(set)
    for r in rows:
        where[r.text].add(r.shard)
    assert all(len(s) == 1 for s in where.values())


def test_odd_and_empty_shards(odd_docs, no_docs):
    rows = sharding.shard(odd_docs, 3).collect()
    assert len(rows) == odd_docs.count()
    assert {r["size"] for r in rows if r.text is None} == {16}
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert sharding.shard(no_docs, 3).count() == 0


def test_shards_against_a_plain_sort(spark):
    """Boundaries by brute force: the sorted rows' running bytes cut nearest to each shard's share."""
    docs = spark.range(5000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.md5(F.col("id").cast("string")), (F.col("id") % 17 + 1).cast("int")).alias("text"),
    )
    rows = sharding.shard(docs, 10).withColumn("h", F.xxhash64("text")).collect()
    rows.sort(key=lambda r: (r.h, r.doc_id))
    total, at, share = sum(r["size"] for r in rows), 0, 0
    off = sharding.TOLERANCE / 10 * total + 17 * 32 + 16
    for r in rows:
        assert (r.shard - 0.0) * total / 10 - off <= at <= (r.shard + 1) * total / 10 + off
        assert r.shard >= share
        share, at = r.shard, at + r["size"]


def test_driver_work_does_not_grow_with_bytes(spark, monkeypatch):
    """Probes of ten thousand times the bytes are as many as those of a small table."""
    asked = []

    def below(rows, probes):
        asked.append(len(probes))
        at = (probes[:, 0].astype(float) + 2.0**63) / 2.0**64  # rows spread evenly over the hashes
        return np.rint(at * 10**13).astype(np.int64), np.rint(at * 10**10).astype(np.int64)

    monkeypatch.setattr(sharding, "_below", below)
    totals = spark.createDataFrame([(10**13,)], "size long")
    cuts, _ = sharding.splitters(totals, [i / 40 for i in range(1, 40)], sharding.TOLERANCE / 40)
    assert len(cuts) == 39 and cuts == sorted(cuts) and sum(asked) < 10_000

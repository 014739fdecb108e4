import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from platewright.llm import warc

PAGES = "page_id long, url string, html string, payload_digest string, refers_to int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "own", 7) for r in rows], PAGES)


def read_back(spark, docs, folder, file_records=5000):
    warc.write_archives(warc.resolved(warc.with_headers(docs)), str(folder), file_records)
    return warc.with_original_sizes(warc.read_archives(spark, str(folder)))


def brute(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        original = max(same) if len(data) >= 1000 and same else None
        other = original if original != page else None
        out.append((page, "revisit" if other is not None else "response", len(data), hashlib.sha1(data).hexdigest(), other))
    return sorted(out, key=str)


@pytest.mark.parametrize("file_records", [5000, 3])
def test_round_trip(spark, tmp_path, file_records):
    rng = random.Random(0)
    bodies = ["x" * 1000, "x" * 999, "é" * 500, "é" * 499, None, "", "\r\n\r\nWARC/1.1\r\n" * 60, "a\r\n\r\n", "<p>\x00\x1f😀" * 300, "z" * 300_000]
    rows = [(i, rng.choice(["http://a/b c", "http://x\r\nWARC-Type: evil", None, "http://é"]), rng.choice(bodies)) for i in range(80)]
    rows += [(3, "http://again", rows[3][2]), (None, None, "y" * 2000), (None, "u", "x" * 1000)]
    got = read_back(spark, pages(spark, rows), tmp_path / "w", file_records).collect()
    found = [(r["page_id"], r["record_type"], r["payload_bytes"], r["payload_digest"], r["refers_to"]) for r in got]
    assert sorted(found, key=str) == brute(rows)
    assert not any("\n" in r["url"] or " " in r["url"] for r in got)


def test_files_are_archives(spark, tmp_path):
    rows = [(1, "http://a", "b" * 1200), (2, "http://c", "b" * 1200), (3, "http://d", "small")]
    read_back(spark, pages(spark, rows).coalesce(1), tmp_path / "w")
    records = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("*.gz")).split(b"WARC/1.1\r\n")[1:]
    assert len(records) == 3
    assert sum(b"WARC-Type: revisit" in r and b"WARC-Refers-To: <urn:page:2>" in r for r in records) == 1
    assert sum(b"b" * 1200 in r for r in records) == 1
    assert all(r.endswith(b"\r\n\r\n") for r in records)


def test_a_hot_payload(spark, tmp_path):
    docs = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("http://u").alias("url"), F.lit("h" * 1500).alias("html"))
    got = read_back(spark, docs, tmp_path / "w")
    assert got.where("record_type = 'response'").select("page_id").first()[0] == 2999
    assert got.where("refers_to = 2999 AND payload_bytes = 1500").count() == 2999


@pytest.mark.parametrize("small", [True, False])
def test_payloads_are_shuffled_only_to_many_digests(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(warc, "is_small", lambda twice: small)
    rows = [(i, "u", "abc"[i % 3] * 1500) for i in range(30)] + [(100, "v", "d" * 1500)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = warc.resolved(warc.with_headers(spark.read.parquet(f"{tmp_path}/pages")))
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {r["page_id"]: r["refers_to"] for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("Exchange hashpartitioning(payload_digest" in plan) != small
    assert got == {i: 27 + i % 3 if i < 27 else None for i in range(30)} | {100: None}


def test_a_damaged_payload_is_an_error(tmp_path):
    record = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Target-URI: u\r\n"
              f"WARC-Payload-Digest: sha1:{'0' * 40}\r\nContent-Length: {len(warc.HTTP) + 1}\r\n\r\n{warc.HTTP}x\r\n\r\n")
    with pytest.raises(ValueError, match="digest"):
        list(warc._parse(gzip.compress(record.encode())))
    with pytest.raises(ValueError, match="begins"):
        list(warc._parse(gzip.compress(b"junk")))


def test_no_pages(spark, tmp_path):
    assert read_back(spark, pages(spark, []), tmp_path / "w").collect() == []

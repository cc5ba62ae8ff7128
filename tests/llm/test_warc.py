"""Archive round trips."""
import hashlib

import pytest
from pyspark.sql import functions as F

from starledger.llm import warc

BIG = "<html>" + "ü" * 100
ROWS = [(3, "http://a/1", BIG), (1, "http://a/2\r\nX: y", BIG), (2, None, "tiny"), (4, "http://a/3", "tiny"), (5, "u", None), (6, "u", ""),
        (7, "u", "x" * 200000), (8, "u", "HTTP\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 9), (None, "n", BIG), (9, "r", "r" * 150),
        (9, "r", "r" * 150), (10, "r2", "r" * 150), (None, "only", "z" * 120)]


def brute(rows):
    out = []
    for pid, _, html in rows:
        data = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        first = min(ids) if ids else None
        visit = len(data) >= 100 and pid != first
        out.append((pid, len(data), hashlib.sha256(data).hexdigest(), "revisit" if visit else "response", first if visit else None))
    return sorted(out, key=str)


def test_archive_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*r, "c", b"x") for r in ROWS], "page_id long, url string, html string, digest string, payload binary")
    path = str(tmp_path / "a")
    warc.write_archive(pages, path)
    got = warc.read_archive(spark, path)
    rows = got.collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows], key=str) == brute(ROWS)
    assert sorted([(r.page_id, bytes(r.payload).decode()) for r in rows], key=str) == sorted([(p, h or "") for p, _, h in ROWS], key=str)
    stored = spark.read.parquet(path + "/payloads")
    assert stored.count() == stored.select("digest").distinct().count() == len({(h or "") for _, _, h in ROWS})

    warc.export_warc(got, path + "/files", records_per_file=3)
    back = warc.import_warc(spark, path + "/files").collect()
    assert sorted(bytes(r.header) for r in back) == sorted(bytes(r.header) for r in rows)
    want = sorted(bytes(r.payload) if r.record_type == "response" else b"" for r in rows)
    assert sorted(bytes(r.block) for r in back) == want


def test_damage_is_found_and_empty_archive_reads(spark, tmp_path):
    pages = spark.createDataFrame(ROWS[:3], "page_id long, url string, html string")
    path = str(tmp_path / "a")
    warc.write_archive(pages, path)
    bad = str(tmp_path / "b")
    spark.read.parquet(path + "/records").write.parquet(bad + "/records")
    spark.read.parquet(path + "/payloads").withColumn("payload", F.concat("payload", F.lit("x").cast("binary"))).write.parquet(bad + "/payloads")
    with pytest.raises(Exception, match="damaged"):
        warc.read_archive(spark, bad).collect()
    empty = str(tmp_path / "e")
    warc.write_archive(pages.limit(0), empty)
    assert warc.read_archive(spark, empty).count() == 0

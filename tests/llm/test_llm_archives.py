"""WARC records: writing, reading step by step, damage, and the round trip of pages."""

import base64
import gzip
import hashlib
import io
import random

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from opdiag.llm import warc
from opdiag.llm.queries import QUERIES
from opdiag.session import scratch_path


def archive(*payloads):
    return b"".join(
        warc.record_bytes(at, f"http://x/{at}", data, warc.base32_sha1(data), None, False)
        for at, data in enumerate(payloads)
    )


def test_every_record_is_a_member():
    data = archive(b"one", b"two")
    first = gzip.decompress(data)
    assert first.count(b"WARC/1.1\r\n") == 2
    assert data.count(b"\x1f\x8b\x08") >= 2


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 18])
def test_reader_goes_step_by_step(monkeypatch, block):
    monkeypatch.setattr(warc, "BLOCK_BYTES", block)
    draw = random.Random(4)
    payloads = [b"", b"\r\n\r\nWARC/1.1\r\n", draw.randbytes(3000), b"a" * 20_000, "é\n".encode() * 50]
    found = list(warc.read_records(io.BytesIO(archive(*payloads))))
    assert [r["payload_bytes"] for r in found] == [len(x) for x in payloads]
    assert [r["payload_digest"] for r in found] == [
        base64.b32encode(hashlib.sha1(x).digest()).decode() for x in payloads
    ]
    assert all(r["digests_hold"] for r in found)


def test_reader_tells_wrong_digests():
    data = warc.record_bytes(1, "u", b"payload", warc.base32_sha1(b"other"), None, False)
    assert [r["digests_hold"] for r in warc.read_records(io.BytesIO(data))] == [False]


def test_reader_stops_at_damage():
    data = archive(b"x" * 5000, b"y" * 5000)
    for cut in (10, len(data) - 20):
        with pytest.raises(warc.DamagedArchive):
            list(warc.read_records(io.BytesIO(data[:cut])))
    with pytest.raises(warc.DamagedArchive):
        list(warc.read_records(io.BytesIO(gzip.compress(b"no record\r\n\r\n"))))
    assert list(warc.read_records(io.BytesIO(b""))) == []


def test_reader_takes_records_of_others():
    head = b"WARC/1.0\r\nwarc-type: warcinfo\r\nX-Long: a\r\n b\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    found = list(warc.read_records(io.BytesIO(gzip.compress(head + head))))
    assert [r["payload_bytes"] for r in found] == [5, 5]
    assert found[0]["fields"]["x-long"] == "a b"


PAGES = [
    (1, "http://a/\n1", "same"), (2, None, "same"), (3, "http://c", "same"), (3, "http://c", "same"),
    (4, "d", None), (5, "e", ""), (6, "f", "é" * 100_000), (None, "g", "same"), (None, "h", "alone"),
    (7, "i", "last"),
]


def test_round_trip_of_odd_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns(
        {"digest": F.lit(1), "path": F.lit("x")}
    )
    rows = warc.round_trip(spark, pages).collect()
    got = sorted(
        ((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in rows), key=str
    )
    assert got == sorted([
        (1, "revisit", 3, 4), (2, "revisit", 3, 4), (3, "response", None, 4), (3, "response", None, 4),
        (4, "revisit", 5, 0), (5, "response", None, 0), (6, "response", None, 200_000),
        (None, "revisit", 3, 4), (None, "response", None, 5), (7, "response", None, 4),
    ], key=str)
    assert all(r.digests_hold for r in rows)


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rows = warc.round_trip(spark, pages, min_payload=5).collect()
    assert {r.record_type for r in rows if r.payload_bytes < 5} == {"response"}


def test_archives_roll_and_manifest_counts(spark, monkeypatch):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(warc.plan_records(pages), folder)
    assert manifest.agg(F.sum("records")).first()[0] == pages.count()
    records = warc.read_archives(manifest)
    assert records.filter("not digests_hold").count() == 0
    assert records.count() == pages.count()


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(spark, empty).count() == 0


def test_query_returns_every_page(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = {r.page_id: r for r in QUERIES["op8_warc"](spark, SMALL).collect()}
    for page in pages.collect():
        data = (page.html or "").encode()
        assert rows[page.page_id].payload_bytes == len(data)
        assert rows[page.page_id].payload_digest == warc.base32_sha1(data)


def test_records_that_do_not_verify_raise(spark):
    good = spark.createDataFrame([("a", True)], "path string, digests_hold boolean")
    bad = spark.createDataFrame([("b", False), ("c", None)], "path string, digests_hold boolean")
    assert warc.verified(good).count() == 1
    for path in ("b", "c"):
        with pytest.raises(Exception, match="digests do not hold in " + path):
            warc.verified(good.union(bad.filter(f"path = '{path}'"))).collect()

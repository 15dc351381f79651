"""WARC source: round trips, pushed predicates, skipped payloads, foreign archives."""

import gzip
import io

import pytest
from pyspark.sql import functions as F

from epipanel.llm import warc
from epipanel.llm.warc import digest, page_records, read_records, read_warc, record_bytes, write_warc

ROWS = [
    (1, "http://a/1", "same"), (5, "http://a/5", "same"), (3, None, None), (2, "http://a\r\nWARC-Type: evil", ""), (4, "u", "x" * 300_000),
    (6, "u", "a\r\n\r\nWARC/1.1\r\n\r\nb é"), (7, "u", "dup7"), (7, "u", "dup7"), (None, "u", "same"), (None, "u", "alone"),
]


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)


def test_round_trip(spark, pages, tmp_path):
    frame = pages(ROWS).withColumn("payload", F.lit(1)).withColumn("key", F.lit(2)).withColumn("first", F.lit(3))
    write_warc(page_records(frame), str(tmp_path / "w"), roll_bytes=500)
    rows = read_warc(spark, str(tmp_path / "w")).collect()
    assert len(rows) == len(ROWS)
    by = {}
    for r in rows:
        by.setdefault(r["record_id"], []).append(r)
    for page_id, _, html in ROWS:
        data = (html or "").encode()
        found = by[f"<urn:page:{'' if page_id is None else page_id}>"]
        assert any(r["payload_bytes"] == len(data) and r["payload_digest"] == "sha1:" + digest(data) for r in found)
    one = lambda i: by[f"<urn:page:{i}>"][0]
    assert (one(1)["record_type"], bytes(one(1)["payload"])) == ("response", b"same")
    assert (one(5)["record_type"], one(5)["refers_to"], one(5)["payload"]) == ("revisit", "<urn:page:1>", None)
    assert (one(2)["record_type"], one(3)["refers_to"]) == ("response", "<urn:page:2>")
    assert bytes(one(6)["payload"]).decode() == ROWS[5][2]
    assert [r["record_type"] for r in by["<urn:page:7>"]] == ["response"] * 2
    assert sorted(r["record_type"] for r in by["<urn:page:>"]) == ["response", "revisit"]
    assert one(2)["target_uri"] == "http://a%0D%0AWARC-Type: evil"


def test_small_payloads_are_not_revisits_below_the_limit(pages):
    kinds = {r["record_id"]: r["record_type"] for r in page_records(pages(ROWS), min_revisit_bytes=5).collect()}
    assert kinds["<urn:page:5>"] == "response" and set(kinds.values()) == {"response"}


def test_predicates_reach_the_reader(spark, pages, tmp_path):
    write_warc(page_records(pages(ROWS)), str(tmp_path / "w"))
    found = read_warc(spark, str(tmp_path / "w"), "record_type string, record_id string").where("record_type = 'revisit'")
    plan = found._jdf.queryExecution().explainString(found._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [IsNotNull(record_type), EqualTo(record_type,revisit)]" in plan
    assert {r["record_id"] for r in found.collect()} == {"<urn:page:5>", "<urn:page:3>", "<urn:page:>"}
    starts = read_warc(spark, str(tmp_path / "w"), "target_uri string").where("target_uri like 'http://a/%'")
    assert starts.count() == 2


class Counting(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        data = super().read(n)
        self.taken += len(data)
        return data


def test_unwanted_records_are_passed_over():
    import os

    big = {"record_type": "response", "record_id": "big", "payload": os.urandom(3_000_000)}
    small = {"record_type": "response", "record_id": "small", "payload": b"ok"}
    file = Counting(record_bytes(big) * 3 + record_bytes(small))
    rows = list(read_records(file, lambda row: row["record_id"] == "small", True))
    assert [r["payload"] for r in rows] == [b"ok"]
    assert file.taken < 100_000


def test_foreign_archives(spark, tmp_path):
    def plain(kind, ident, body):
        return (
            f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {ident}\r\nContent-Type: text/plain\r\n"
            f"Content-Length: {len(body)}\r\n\r\n"
        ).encode() + body + b"\r\n\r\n"

    records = [plain("warcinfo", "a", b"info"), plain("response", "b", b"body\r\n\r\nmore"), plain("response", "c", b"")]
    (tmp_path / "one.warc").write_bytes(b"".join(records))
    (tmp_path / "two.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "other.txt").write_bytes(b"no archive")
    rows = read_warc(spark, str(tmp_path)).where("record_type = 'response'").collect()
    assert sorted((r["record_id"], bytes(r["payload"])) for r in rows) == [("b", b"body\r\n\r\nmore")] * 2 + [("c", b"")] * 2


def test_empty_table(spark, pages, tmp_path):
    write_warc(page_records(pages([])), str(tmp_path / "w"))
    assert read_warc(spark, str(tmp_path / "w")).collect() == []


def test_files_outside_the_manifest_are_ignored(spark, pages, tmp_path):
    write_warc(page_records(pages(ROWS[:1])), str(tmp_path / "w"))
    (tmp_path / "w" / "part-lost.warc.gz").write_bytes(record_bytes({"record_id": "lost", "payload": b"x"}))
    assert read_warc(spark, str(tmp_path / "w")).count() == 1
    assert warc.MANIFEST in {p.name for p in (tmp_path / "w").iterdir()}

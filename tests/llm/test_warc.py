import base64
import gzip
import glob
import hashlib
import io

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.llm import warc
from tributary.llm.losertree import merge_runs
from tributary.session import local_path, work_dir

SCHEMA = "page_id long, url string, ts timestamp, html string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h) for i, u, h in rows], "page_id long, url string, html string").withColumn(
        "ts", F.timestamp_seconds(F.lit(1_700_000_000) - F.coalesce("page_id", F.lit(0))))


@given(st.lists(st.lists(st.integers(0, 9))))
def test_loser_tree(runs):
    tagged = [sorted((x, n) for x in run) for n, run in enumerate(runs)]
    got = list(merge_runs(tagged, key=lambda t: t[0]))
    assert got == sorted((t for r in tagged for t in r), key=lambda t: t[0])  # stable: equal keys by run


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


NASTY = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n<p>é🤦</p>\0\r\n\r\n"


def test_what_was_written_comes_back(spark):
    rows = [(5, "http://a.org/x", "same"), (2, "http://b.org/", "same"), (9, "http://a.org/x?y#z", "same"), (1, "u", NASTY),
            (3, None, None), (4, "http://a.org/x", ""), (6, "v", "long " * 100_000), (7, "w\r\nX: y", NASTY)]
    got = {r["page_id"]: r for r in warc.archive_and_index(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        first = min(j for j, _, h in rows if (h or "") == (html or ""))
        r = got[str(i)]
        assert (r["payload_bytes"], r["payload_digest"]) == (len((html or "").encode()), digest(html))
        assert (r["record_type"], r["refers_to"]) == (("response", None) if i == first else ("revisit", str(first)))


def test_files_are_warc(spark):
    path = work_dir(spark, "warc-test")
    warc.write_archives(pages(spark, [(1, "http://a.org/", NASTY), (2, "http://a.org/", NASTY)]).coalesce(1), path)
    seen = {}
    for name in glob.glob(local_path(path) + "/*.gz"):
        raw = gzip.open(name).read()
        for offset, size, head, block in warc.parse_records(io.BytesIO(raw)):
            assert raw[offset:offset + 8] == b"WARC/1.1" and raw[offset + size - 4:offset + size] == b"\r\n\r\n"
            seen[head["warc-record-id"]] = head["warc-type"], block
    assert seen["<urn:capture:1>"][1].endswith(NASTY.encode()) and seen["<urn:capture:1>"][0] == "response"
    assert seen["<urn:capture:2>"][0] == "revisit" and seen["<urn:capture:2>"][1].endswith(b"\r\n\r\n")
    with pytest.raises(ValueError, match="no WARC record"):
        list(warc.parse_records(io.BytesIO(raw + b"junk")))


def test_index_is_in_global_order(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_ARCHIVE", 7)
    rows = [(i, f"http://www.H{i % 5}.example.org:80/p{i % 3}", f"page {i % 11}") for i in range(120)]
    path = work_dir(spark, "warc-order")
    warc.write_archives(pages(spark, rows).repartition(3), path)
    entries = warc.read_index(spark, path)
    got = warc.merged_index(entries, entries_per_range=20).orderBy("range", "place").collect()
    assert len({r["archive"] for r in got}) >= 15 and len({r["range"] for r in got}) > 2
    keys = [(r["url_key"], r["ts"], int(r["page_id"])) for r in got]
    assert keys == sorted(keys) and len(keys) == 120
    assert got[0]["url_key"] == "org,example,h0)/p0"


def test_small_payloads_are_never_revisits(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    got = {r["page_id"]: r["record_type"] for r in warc.archive_and_index(pages(spark, rows), dedup_from=3).collect()}
    assert got == {"1": "response", "2": "response", "3": "response", "4": "revisit"}


def test_edge_rows(spark):
    rows = [(None, "u", "x"), (None, "u", "x"), (1, "u", "x"), (1, "u", "x"), (None, None, "alone")]
    df = pages(spark, rows).withColumn("payload", F.lit("clash")).withColumn("ts", F.when(F.col("html") == "x", F.col("ts")))
    got = sorted((r["page_id"] or "", r["record_type"], r["refers_to"] or "") for r in warc.archive_and_index(df).collect())
    assert got == [("", "response", ""), ("", "revisit", "1"), ("", "revisit", "1"), ("1", "response", ""), ("1", "response", "")]
    assert warc.archive_and_index(df.limit(0)).count() == 0

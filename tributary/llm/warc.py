"""WARC archives of pages, and the merged index of their captures.

Archives are written by Spark's text writer, one WARC record a row with the
record's closing blank lines as the row separator, so files come with Spark's
own commit protocol on any store.  Payloads that were seen before become
``revisit`` records of the first one.  Reading goes by the records' lengths.
Each archive gives one locally sorted run of index entries; the runs are dealt
by ranges of (URL key, timestamp, id) and every range is merged by a loser
tree, so the ranges together are the captures of all archives in global order.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.common import with_group_min, written
from tributary.llm.losertree import merge_runs
from tributary.session import work_dir

# The record format.
VERSION, CRLF, RECORD_END = "WARC/1.1", "\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:capture:"
#: Records in a file, and index entries in a merged range, at most about so many.
RECORDS_PER_ARCHIVE, ENTRIES_PER_RANGE = 1000, 50_000
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five bits of the digest a letter."""
    bits = F.concat(*(F.lpad(F.conv(F.substring(F.sha1(data), i, 8), 16, 2), 32, "0") for i in range(1, 41, 8)))
    parts = [F.substring(F.lit(BASE32), F.conv(F.substring(bits, i, 5), 2, 10).cast("int") + 1, 1) for i in range(1, 161, 5)]
    return F.concat(*parts)


def url_key(url: Column) -> Column:
    """Canonical key that sorts a site's pages together: the host's labels
    from the last to the first, then path and query, without scheme, leading
    ``www.``, port and fragment, in lower case; empty for a null URL."""
    bare = F.regexp_replace(F.lower(F.trim(F.coalesce(url, F.lit("")))), r"^[a-z][a-z0-9+.-]*://|#.*$", "")
    host = F.regexp_replace(F.regexp_extract(bare, r"^([^/?]*)", 1), r"^[^@]*@|^www\d*\.|:\d*$", "")
    path = F.substring(bare, F.length(F.regexp_extract(bare, r"^([^/?]*)", 1)) + 1, 2**31 - 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(path == "", "/").otherwise(path))


def decide(pages: DataFrame, dedup_from: int = 0) -> DataFrame:
    """pages (page_id, url, ts, html) plus payload, payload_bytes, payload_digest, first_id and
    record_type.  Of equal payloads of at least ``dedup_from`` bytes the
    smallest page_id's (all rows with that id) is a response, the others are revisits of
    it; smaller payloads, and groups without any id, are all responses."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    size = F.octet_length(payload).cast("long")
    rows = pages.select("page_id", "url", "ts", payload.alias("payload"), size.alias("payload_bytes"),
                        F.sha1(payload.cast("binary")).alias("sha"))
    rows = rows.withColumn("group", F.when(F.col("payload_bytes") >= dedup_from, F.col("sha")))
    rows = with_group_min(rows, "group", "page_id", "first_id")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.select("page_id", "url", "ts", "payload", "payload_bytes", base32_sha1(F.col("payload").cast("binary")).alias("payload_digest"),
                       F.when(again, F.col("first_id")).alias("refers_to"),
                       F.when(again, "revisit").otherwise("response").alias("record_type"))


def records(decided: DataFrame) -> DataFrame:
    """One WARC record a row, as text and without its closing blank lines."""
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit(CRLF))

    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(RECORD_END))
    block = F.concat(http, F.when(F.col("record_type") == "response", F.col("payload")).otherwise(""))
    uri = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\x00-\x20\x7f]", "")
    when = F.to_utc_timestamp(F.coalesce(F.col("ts"), F.timestamp_seconds(F.lit(0))), F.current_timezone())
    ident = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    head = F.concat(
        F.lit(VERSION + CRLF), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit(f"<{ID}"), ident, F.lit(">"))),
        line("WARC-Target-URI", uri), line("WARC-Date", F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(F.col("record_type") == "revisit", F.concat(
            line("WARC-Profile", F.lit(PROFILE)),
            line("WARC-Refers-To", F.concat(F.lit(f"<{ID}"), F.col("refers_to").cast("string"), F.lit(">"))))).otherwise(""),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")))
    return decided.select(F.concat(head, F.lit(CRLF), block).alias("value"))


def write_archives(pages: DataFrame, path: str, dedup_from: int = 0) -> None:
    """Write pages (page_id, url, ts, html) as WARC files under ``path``."""
    records(decide(pages, dedup_from)).write.option("lineSep", RECORD_END).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_ARCHIVE).text(path)


def parse_records(stream) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of each record of an archive."""
    offset = 0
    while line := stream.readline():
        size = len(line)
        if line.strip() != VERSION.encode():
            raise ValueError(f"no WARC record at byte {offset}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            size += len(line)
            name, _, value = line.decode("utf-8", errors="replace").partition(":")
            headers[name.lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        end = stream.read(len(RECORD_END))
        size += 2 + len(block) + len(end)
        if end != RECORD_END.encode() or len(block) != int(headers["content-length"]):
            raise ValueError(f"a cut record at byte {offset}")
        yield offset, size, headers, block
        offset += size


ENTRY = ("archive string, offset long, length long, url string, ts string, page_id string, record_type string, "
         "refers_to string, payload_bytes long, payload_digest string")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all records under ``path``.  A response's size and
    digest are taken from its payload as read, and have to be those in its
    headers; a revisit's are its headers'."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path).select("path", "content")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for offset, size, head, block in parse_records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())))):
                    http, _, payload = block.partition(RECORD_END.encode())
                    said = int(http.rpartition(b"Content-Length: ")[2])
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    if head["warc-type"] == "response" and (
                            len(payload) != said or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"{name}: the payload at byte {offset} is not what its headers say")
                    ids = [head.get(h, "").removeprefix(f"<{ID}").removesuffix(">") or None for h in ("warc-record-id", "warc-refers-to")]
                    rows.append((name.rpartition("/")[2], offset, size, head["warc-target-uri"], head["warc-date"],
                                 ids[0], head["warc-type"], ids[1], said, digest))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) if k not in (5, 7) else pa.array(c, pa.string()) for k, c in enumerate(zip(*rows))],
                                                     [f.split()[0] for f in ENTRY.split(", ")])

    return files.mapInArrow(run, ENTRY)


def merged_index(entries: DataFrame, entries_per_range: int = ENTRIES_PER_RANGE) -> DataFrame:
    """Entries plus url_key, range and place: in order of (range, place) they
    are all captures by URL key, timestamp, id, archive and offset."""
    order = ["url_key", "ts", "id_order", "archive", "offset"]
    runs = written(entries.withColumn("url_key", url_key(F.col("url"))).withColumn(
        "id_order", F.coalesce(F.col("page_id").cast("long"), F.lit(-1))).repartition("archive").sortWithinPartitions("archive", *order[:3], "offset"), "captures")
    ranges = max(1, -(-runs.count() // entries_per_range))
    names = runs.columns

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        rows: dict[str, list] = {}  # a run's entries of this range, in the run's order
        for batch in batches:
            for r in batch.to_pylist():
                rows.setdefault(r["archive"], []).append(r)
        out, place = [], 0
        for r in merge_runs([rows[a] for a in sorted(rows)], key=lambda r: tuple(r[c] for c in order)):
            out.append(r | {"range": TaskContext.get().partitionId(), "place": place})
            place += 1
            if len(out) == 5000:
                yield pa.RecordBatch.from_pylist(out, schema=schema(pa))
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema(pa))

    def schema(pa):
        kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
        return pa.schema({**{n: kinds[k] for n, k in types}, "range": pa.int32(), "place": pa.int64()})

    types = runs.dtypes
    dealt = runs.repartitionByRange(ranges, *order).sortWithinPartitions("archive", *order[:3], "offset")
    return dealt.mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in types) + ", range int, place long").select(*names, "range", "place")


def archive_and_index(pages: DataFrame, dedup_from: int = 0) -> DataFrame:
    """Write pages (page_id, url, ts, html) as WARC archives in the shared
    folder, read them back and return the merged index of their captures.

    Null html is an empty payload, a null url an empty target and key, a null ts
    the epoch; a null page_id is a capture without a number; rows with equal id and payload are
    captures each (all of them responses where the id is the group's
    smallest); other columns are ignored; an empty table has an empty index.
    """
    path = work_dir(pages.sparkSession, "warc")
    write_archives(pages, path, dedup_from)
    return merged_index(read_index(pages.sparkSession, path))

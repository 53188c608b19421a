"""CSV files with quoted line feeds, read by many tasks a file.

Spark's own reader takes such a file whole.  Here the text source deals its
lines over byte ranges; a line ends a record if an even number of quotes has come
before that end in the whole file.  Each range's own parity, and how many records
end in it under either parity at its start, are one row a range; a running sum over a
file's ranges tells each range's start, and so every line its record's number.
A record that begins and ends in one range stays where it was read; only the parts of
those that cross a border meet again, by their number.  Quotes inside quoted fields are
doubled, as the writers here do; a lone quote in an unquoted field is not CSV.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.frontier import cut_counting

#: So many ranges (32 bytes each) go to every task; more are joined by a shuffle.
SMALL = 50_000
RANGES = "file long, start long, odd int, ends_even long, ends_odd long"
LINES = "file long, start long, seq long, line string, odd_before int, odd_after int, nth_even long, nth_odd long"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _walk(batches: Iterator[pa.RecordBatch], ranges_only: bool) -> Iterator[pa.RecordBatch]:
    """The lines of a task's ranges in order: the parity of quotes, within the
    range, before and after each line, and how many lines before it end even or odd."""
    now, odd, seq, even_ends, odd_ends = None, 0, 0, 0, 0

    def summary():
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*now, odd, even_ends, odd_ends), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                          ["file", "start", "odd", "ends_even", "ends_odd"])

    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = (batch.column(c).to_numpy() for c in ("file", "start"))
        quotes = pc.count_substring(batch.column("line"), '"').to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            if now != (file[lo], start[lo]):
                if now is not None and ranges_only:
                    yield summary()
                now, odd, seq, even_ends, odd_ends = (file[lo], start[lo]), 0, 0, 0, 0
            after = (odd + np.cumsum(quotes[lo:hi])) % 2
            before = np.concatenate([[odd], after[:-1]])
            nth_odd = odd_ends + np.cumsum(after) - after
            nth_even = even_ends + np.cumsum(1 - after) - (1 - after)
            if not ranges_only:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file[lo:hi]), pa.array(start[lo:hi]), pa.array(np.arange(seq, seq + hi - lo)), batch.column("line").slice(lo, hi - lo),
                     pa.array(before, pa.int32()), pa.array(after, pa.int32()), pa.array(nth_even, pa.int64()), pa.array(nth_odd, pa.int64())],
                    ["file", "start", "seq", "line", "odd_before", "odd_after", "nth_even", "nth_odd"])
            odd, seq = int(after[-1]), seq + int(hi - lo)
            odd_ends, even_ends = int(nth_odd[-1] + after[-1]), int(nth_even[-1] + 1 - after[-1])
    if now is not None and ranges_only:
        yield summary()


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of ranges in order, with each range's parity at its start and the
    number of its first record -> records, and the parts of those that cross a border."""
    now, odd, record, head, held = None, 0, 0, False, []
    out: list[tuple] = []

    def flush():
        rows = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()))],
                                          ["file", "record", "start", "whole", "text"])
        out.clear()
        return rows

    def leave():
        if held:  # open at the range's end
            out.append((*now[:1], record, now[1], False, "\n".join(held)))
            held.clear()

    for batch in batches:
        if not batch.num_rows:
            continue
        file, start, first, base = (batch.column(c).to_numpy() for c in ("file", "start", "first", "base"))
        quotes = pc.count_substring(batch.column("line"), '"').to_numpy(zero_copy_only=False)
        lines = batch.column("line").to_pylist()
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if now != (int(file[lo]), int(start[lo])):
                if now is not None:
                    leave()
                now, odd, record = (int(file[lo]), int(start[lo])), int(first[lo]), int(base[lo])
                head = odd == 1  # its first record began in an earlier range
            after = (odd + np.cumsum(quotes[lo:hi])) % 2
            for end in (lo + np.flatnonzero(after == 0) + 1).tolist():
                held.extend(lines[lo:end])
                out.append((now[0], record, now[1], not head, "\n".join(held)))
                held.clear()
                lo, record, head = end, record + 1, False
            held.extend(lines[lo:hi])
            odd = int(after[-1])
        if out:
            yield flush()
    if now is not None:
        leave()
        if out:
            yield flush()


def records(spark: SparkSession, path: str, small: int = SMALL) -> DataFrame:
    """(file, record number from 0, text) of every record of the CSV files at
    ``path``, header lines included.  An unclosed quote makes the rest of its
    file one record.  Up to ``small`` ranges are sent to the tasks, which put records
    together as they read; with more, ranges and lines meet in a shuffle."""
    ranges = _lines(spark, path).mapInArrow(lambda b: _walk(b, True), RANGES)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("first", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    ranges = ranges.withColumn("base", F.coalesce(F.sum(F.when(F.col("first") == 0, F.col("ends_even")).otherwise(F.col("ends_odd"))).over(before), F.lit(0)))
    ranges, n = cut_counting(ranges.select("file", "start", F.col("first").cast("int").alias("first"), "base"))
    if n <= small:
        # a broadcast join keeps the lines of a task in the order they were read
        parts = _lines(spark, path).join(F.broadcast(ranges), ["file", "start"]).mapInArrow(
            _assemble, "file long, record long, start long, whole boolean, text string")
        order = F.struct("start", F.lit(0).alias("seq"), F.col("text").alias("line"))
        whole = F.col("whole")
    else:
        parts = _lines(spark, path).mapInArrow(lambda b: _walk(b, False), LINES).join(ranges, ["file", "start"])
        parts = parts.withColumn("record", F.col("base") + F.when(F.col("first") == 0, F.col("nth_even")).otherwise(F.col("nth_odd"))).withColumn("text", F.col("line"))
        order = F.struct("start", "seq", "line")
        whole = (F.col("odd_before") == F.col("first")) & (F.col("odd_after") == F.col("first"))
    lines = F.transform(F.array_sort(F.collect_list(order)), lambda p: p["line"])
    joined = parts.where(~whole).groupBy("file", "record").agg(F.array_join(lines, "\n").alias("text"))
    return parts.where(whole).select("file", "record", "text").unionByName(joined)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, options: dict) -> DataFrame:
    """The rows of the CSV files at ``path``, each with a header line, as
    Spark's reader would parse them; empty lines are no rows."""
    options = {k: v for k, v in options.items() if k not in ("header", "multiLine", "lineSep")}
    rows = records(spark, path).where("record > 0 AND text <> ''")
    return rows.select(F.from_csv("text", schema.toDDL(), options).alias("row")).select("row.*")

"""Distributed file fetch (op B7).

A manifest of files becomes one outcome row per file: ``status`` (HTTP-like
code), ``reason``, ``length`` and ``content``.  Two ways to fetch:

* ``fetch_from_table`` -- content already sits in a table keyed by id (or a
  previous landing): one left join, all JVM-side.
* ``fetch_with`` -- an injected ``fetcher(url) -> (status, reason, bytes)``
  called from the executors in Arrow batches.  Tasks can run twice, so the
  fetcher must be idempotent; bodies travel as a column and Spark writes
  them.  Failures never stop the job: they become outcome rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

OUTCOME_FIELDS = [
    T.StructField("status", T.IntegerType()),
    T.StructField("reason", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
]

# Reason phrases for the two outcomes a table fetch can have.
REASON_OK = "OK"
REASON_NOT_FOUND = "Not Found"


def fetch_from_table(manifest: DataFrame, content: DataFrame, key: str,
                     content_key: str, body: str, salt_buckets: int = 0) -> DataFrame:
    """Outcome per manifest row: 200 with the body when the content table has
    the key, else 404.  ``salt_buckets`` spreads a hot key (see
    ``functions.skew``)."""
    from tributary.functions.skew import salted_join
    c = content.select(F.col(content_key).alias("_ck"), F.col(body).alias("_body"))
    j = salted_join(manifest, c, None, [(key, "_ck")], salt_buckets, "left")
    found = F.col("_ck").isNotNull()
    data = F.col("_body") if dict(c.dtypes)["_body"] == "binary" else F.encode(F.col("_body"), "UTF-8")
    return j.select(
        *[manifest[x] for x in manifest.columns],
        F.when(found, 200).otherwise(404).cast("int").alias("status"),
        F.when(found, REASON_OK).otherwise(REASON_NOT_FOUND).alias("reason"),
        F.when(found, F.octet_length(data)).cast("long").alias("length"),
        F.when(found, data).alias("content"),
    )


#: Links that a task fetches when the caller names no number of tasks.
LINKS_PER_TASK = 64


def spread(manifest: DataFrame, url_col: str, partitions: int | None) -> DataFrame:
    """Deal a manifest out for fetching: by number of links, since a list of a
    million links is only a few megabytes to Spark."""
    n = partitions or max(1, -(-manifest.count() // LINKS_PER_TASK))
    return manifest.repartition(n, F.xxhash64(url_col, F.rand(7)))


def fetch_with(manifest: DataFrame, fetcher, url_col: str, partitions: int | None = None,
               flush_bytes: int = 64 << 20) -> DataFrame:
    """Outcome per manifest row by calling ``fetcher(url)`` on the executors.

    ``partitions`` is the number of tasks (fetches are I/O-bound, so more
    than cores is normal), by default one for every LINKS_PER_TASK links."""
    schema = T.StructType(list(manifest.schema.fields) + OUTCOME_FIELDS)
    cols = manifest.columns

    kinds = [to_arrow_type(f.dataType) for f in OUTCOME_FIELDS]
    names = [*cols, *(f.name for f in OUTCOME_FIELDS)]

    def run(batches):
        import pyarrow as pa

        def emit(batch, lo, hi, outcomes):
            kept = batch.slice(lo, hi - lo).columns  # the manifest's own columns, as they are
            return pa.RecordBatch.from_arrays([*kept, *(pa.array(c, k) for c, k in zip(zip(*outcomes), kinds))], names)

        for batch in batches:
            outcomes, lo, held = [], 0, 0
            for i, url in enumerate(batch.column(cols.index(url_col)).to_pylist()):
                try:
                    s, r, body = fetcher(url)
                    body = bytes(body) if (body is not None and s == 200) else None
                except Exception as e:  # outcome row, never a failed task
                    s, r, body = -1, f"{type(e).__name__}: {e}", None
                n = None if body is None else len(body)
                outcomes.append((s, r, n, body))
                held += n or 0
                if held >= flush_bytes:  # bodies leave the worker in bounded chunks
                    yield emit(batch, lo, i + 1, outcomes)
                    outcomes, lo, held = [], i + 1, 0
            if outcomes:
                yield emit(batch, lo, batch.num_rows, outcomes)

    return spread(manifest, url_col, partitions).mapInArrow(run, schema)


def fetch_to_folder(manifest: DataFrame, fetcher, url_col: str, target_col: str,
                    partitions: int | None = None) -> DataFrame:
    """Download each file straight to its ``target_col`` path (e.g. from
    ``items.download_manifest``) from the executors; outcome rows carry
    ``status, reason, length`` but no bodies, so file size never becomes
    row size.  Writes go to the target path itself (a retried task rewrites
    the same file), through any filesystem pyarrow can open."""
    fields = [f for f in OUTCOME_FIELDS if f.name != "content"]
    schema = T.StructType(list(manifest.schema.fields) + fields)
    cols = manifest.columns

    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches):
        import pyarrow as pa

        from tributary.session import filesystem
        fs_cache = {}
        for batch in batches:
            outcomes = []
            for url, target in zip(*(batch.column(cols.index(c)).to_pylist() for c in (url_col, target_col))):
                try:
                    s, r, body = fetcher(url)
                    n = None
                    if s == 200 and body is not None:
                        root = target.rsplit("/", 1)[0] or "/"
                        if root not in fs_cache:
                            fs_cache[root] = filesystem(root)
                        fs, base = fs_cache[root]
                        fs.create_dir(base, recursive=True)
                        with fs.open_output_stream(f"{base}/{target.rsplit('/', 1)[-1]}") as fh:
                            fh.write(bytes(body))
                        n = len(body)
                except Exception as e:
                    s, r, n = -1, f"{type(e).__name__}: {e}", None
                outcomes.append((s, r, n))
            columns = zip(*outcomes) if outcomes else ([] for _ in fields)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                             [*cols, *(f.name for f in fields)])

    return spread(manifest, url_col, partitions).mapInArrow(run, schema)

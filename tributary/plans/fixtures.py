"""Inputs derived from the driver tables.

Each derived input is one SQL text with ``{table}`` placeholders, run by
Spark (``spark.sql(text, table=DataFrame)``) and, in the oracles, by DuckDB
with the placeholders replaced by view names.  Sharing the text keeps the
two engines' inputs identical; the operators under test never use it.

Inputs that must exist as files (day partitions, mail files, listing pages)
are written once per Spark application and source folder, under the shared
work folder.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.session import work_dir

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, text: str, **extra: DataFrame) -> DataFrame:
    """Run a shared SQL text on Spark, binding the driver tables it names."""
    binds = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    binds.update(extra)
    return spark.sql(text, **binds)


def duck(text: str) -> str:
    """The same SQL text for DuckDB (tables are pre-registered views)."""
    return text.format(**{t: t for t in TABLES})


# --------------------------------------------------------------------------
# Shared SQL texts
# --------------------------------------------------------------------------

# DAYS: events keyed by their day.
DAYS_SQL = """
SELECT event_id, ts, user_id, event_type, value, props
FROM {events}
"""

# ITEMS: a drive tree -- folders are regions, sub-folders nations, files
# customers.  ``pp`` is the parent path as the remote listing reports it.
ITEMS_SQL = """
SELECT 'R' || CAST(r_regionkey AS STRING) AS id, 'root' AS parent_id, r_name AS name,
       'folder' AS type, '/drives/d0/root:' AS pp,
       CAST(NULL AS STRING) AS mime, CAST(NULL AS STRING) AS dl,
       'https://site.example/R' || CAST(r_regionkey AS STRING) AS web
FROM {region}
UNION ALL
SELECT 'N' || CAST(n_nationkey AS STRING), 'R' || CAST(n_regionkey AS STRING), n_name,
       'folder', '/drives/d0/root:/' || r_name,
       CAST(NULL AS STRING), CAST(NULL AS STRING),
       'https://site.example/N' || CAST(n_nationkey AS STRING)
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
UNION ALL
SELECT 'C' || CAST(c_custkey AS STRING), 'N' || CAST(c_nationkey AS STRING), c_name,
       'file', '/drives/d0/root:/' || r_name || '/' || n_name,
       'text/csv',
       CASE WHEN c_acctbal >= 0 THEN 'https://dl.example/C' || CAST(c_custkey AS STRING) END,
       CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'https://site.example/C' || CAST(c_custkey AS STRING) END
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
"""

# CHANGES: run-log change rows; one run per user, one change per event.
CHANGES_SQL = """
SELECT 'step' || CAST(user_id % 10 AS STRING) || '#$' || CAST(user_id AS STRING) AS run_id,
       'step' || CAST(user_id % 10 AS STRING) AS step_name,
       CASE event_type WHEN 'signup' THEN 'QUEUED' WHEN 'view' THEN 'RUNNING'
            WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED'
            ELSE 'CLICKED' END AS status,
       CASE WHEN event_type = 'error' THEN props END AS error_message,
       CASE WHEN event_type = 'view' THEN ts END AS start_ts,
       CASE WHEN event_type IN ('purchase', 'error') THEN ts END AS end_ts,
       ts AS last_updated_at,
       ts, event_id, user_id
FROM {events}
"""

# ENTITY: an acyclic step graph over every entity; a step depends on the
# entity it hangs off (nation on region, customer/supplier on nation, order
# on customer, on each supplier and part of its line items).
ENTITY_EDGES_SQL = """
SELECT 'R' || CAST(n_regionkey AS STRING) AS src, 'N' || CAST(n_nationkey AS STRING) AS dst FROM {nation}
UNION ALL SELECT 'N' || CAST(c_nationkey AS STRING), 'C' || CAST(c_custkey AS STRING) FROM {customer}
UNION ALL SELECT 'N' || CAST(s_nationkey AS STRING), 'S' || CAST(s_suppkey AS STRING) FROM {supplier}
UNION ALL SELECT 'C' || CAST(o_custkey AS STRING), 'O' || CAST(o_orderkey AS STRING) FROM {orders}
UNION ALL SELECT 'S' || CAST(l_suppkey AS STRING), 'O' || CAST(l_orderkey AS STRING) FROM {lineitem}
UNION ALL SELECT 'P' || CAST(l_partkey AS STRING), 'O' || CAST(l_orderkey AS STRING) FROM {lineitem}
"""

# TRADE: one dependency request per line item -- the customer's nation
# depends on the supplier's nation.  Self loops and repeats are common.
TRADE_SQL = """
SELECT 'N' || CAST(s_nationkey AS STRING) AS src, 'N' || CAST(c_nationkey AS STRING) AS dst,
       s_nationkey AS src_key, c_nationkey AS dst_key,
       sn.n_regionkey AS src_region, cn.n_regionkey AS dst_region,
       l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM {lineitem}
JOIN {orders} ON l_orderkey = o_orderkey
JOIN {customer} ON o_custkey = c_custkey
JOIN {supplier} ON l_suppkey = s_suppkey
JOIN {nation} sn ON s_nationkey = sn.n_nationkey
JOIN {nation} cn ON c_nationkey = cn.n_nationkey
"""

# FLOWS for the cycle check: every line item's trade edge between nations,
# from its supplier into the first, and from the second to its customer.
FLOWS_SQL = """
SELECT 'S' || CAST(l_suppkey AS STRING) AS src, 'N' || CAST(s_nationkey AS STRING) AS dst
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
UNION ALL
SELECT 'N' || CAST(s_nationkey AS STRING), 'N' || CAST(c_nationkey AS STRING)
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
UNION ALL
SELECT 'N' || CAST(c_nationkey AS STRING), 'C' || CAST(c_custkey AS STRING)
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
"""

# Folder paths to resolve, one request per event: region/nation; errors
# ask for a customer (a file, not a folder); clicks use a lower-cased region
# (names are case-sensitive); signups ask for a folder that does not exist.
RESOLVE_REQUESTS_SQL = """
SELECT event_id,
       CASE WHEN event_type = 'error' THEN r_name || '/' || n_name || '/' || c_name
            WHEN event_type = 'click' THEN lower(r_name) || '/' || n_name
            WHEN event_type = 'signup' THEN r_name || '/Unknown'
            ELSE r_name || '/' || n_name END AS path
FROM {events}
JOIN {customer} ON user_id = c_custkey
JOIN {nation} ON c_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
"""

# File ids to fetch, one per order; pending orders ask for unknown ids.
FETCH_REQUESTS_SQL = """
SELECT o_orderkey AS request_id,
       CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE 'C' END || CAST(o_custkey AS STRING) AS file_id
FROM {orders}
"""

# MAIL: one RFC 822 message per customer.
MAIL_SQL = """
SELECT c_custkey AS id,
       c_name || '@x.org' AS sender,
       'a' || CAST(c_nationkey AS STRING) || '@x.org' AS to1,
       'b@x.org' AS to2,
       CASE WHEN c_acctbal < 0 THEN 'm' || CAST(c_nationkey AS STRING) || '@x.org' END AS cc1,
       1704067200 + c_custkey * 60 AS epoch,
       'Segment ' || c_mktsegment AS body
FROM {customer}
"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, ITEMS_SQL)


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, DAYS_SQL).withColumn(
        "partition_value", F.date_format("ts", "yyyy-MM-dd"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, CHANGES_SQL)


def entity_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, ENTITY_EDGES_SQL)


def trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, TRADE_SQL)


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, FLOWS_SQL)


def resolve_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, RESOLVE_REQUESTS_SQL)


def fetch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, FETCH_REQUESTS_SQL)


def mail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, MAIL_SQL)


# --------------------------------------------------------------------------
# Inputs written to files once per application and source folder
# --------------------------------------------------------------------------

_CACHE: dict[tuple, str] = {}
_LOCK = threading.Lock()

DAYS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def _cached(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    with _LOCK:
        if key not in _CACHE:
            _CACHE[key] = build()
        return _CACHE[key]


def days_location(spark: SparkSession, sf_dir: str) -> dict:
    """A ``directory`` location holding ``events`` as one partition per day
    (read-only for queries; writers use their own copies)."""
    from tributary.sources.locations import write_partitions

    def build():
        base = work_dir(spark, "days")
        write_partitions(days(spark, sf_dir), {"days": {"type": "directory", "directory_path": base}},
                         "days")
        return base

    base = _cached(spark, sf_dir, "days", build)
    return {"days": {"type": "directory", "directory_path": base}}


def mail_folder(spark: SparkSession, sf_dir: str) -> str:
    """One ``<id>.eml`` file per customer message, dealt over folders."""
    from tributary.sources.messages import render_messages, write_files

    def build():
        out = work_dir(spark, "mail")
        write_files(render_messages(mail_rows(spark, sf_dir)), out, "file_name", "content",
                    in_folders=True)
        return out

    return _cached(spark, sf_dir, "mail", build)


def text_folder(spark: SparkSession, sf_dir: str) -> str:
    """One ``<doc_id>.txt`` file per document, dealt over folders."""
    from tributary.sources.messages import write_files

    def build():
        out = work_dir(spark, "texts")
        docs = table(spark, sf_dir, "documents")
        write_files(docs.select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"),
                                F.encode("text", "UTF-8").alias("content")), out, "file_name", "content",
                    in_folders=True)
        return out

    return _cached(spark, sf_dir, "texts", build)


def page_store(spark: SparkSession, sf_dir: str, page_size: int) -> str:
    """Listing pages of ITEMS written one file per page (a stand-in for the
    remote service the paged source reads)."""
    from tributary.operators.items import item_pages
    from tributary.sources.messages import write_files

    def build():
        out = work_dir(spark, "pages")
        pages = item_pages(items(spark, sf_dir), page_size)
        write_files(pages.select(F.concat(F.col("page_key"), F.lit(".json")).alias("file_name"),
                                 F.encode("body", "UTF-8").alias("content")),
                    out, "file_name", "content")
        return out

    return _cached(spark, sf_dir, f"pages-{page_size}", build)


def flaky(fn, failures_for):
    """Wrap ``fn`` so that the first ``failures_for(*args)``
    calls for the same first argument (the row key) fail.  Call counts live
    in the task, so a re-run task fails the same way (deterministic)."""
    calls: dict = {}

    def wrapped(*args):
        key = args[0]
        calls[key] = calls.get(key, 0) + 1
        if calls[key] <= failures_for(*args):
            raise RuntimeError(f"injected failure {calls[key]}")
        return fn(*args)

    return wrapped

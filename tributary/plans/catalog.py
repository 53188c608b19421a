"""Registered queries, one per operator key (their DuckDB oracles are in
``oracles``).

Every query reads the driver tables (or files Spark writes from them) in
full; derived inputs come from ``fixtures``.  Column names and types agree
with the oracle of the same key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.errors import EXIT_CODES
from tributary.functions import exprs as X
from tributary.functions import maps as M
from tributary.functions import registry as R
from tributary.operators import deps as E
from tributary.operators import fetch as B7
from tributary.operators import items as B
from tributary.operators import runlog as D
from tributary.plans import fixtures as FX
from tributary.plans import ingest as I
from tributary.session import work_dir
from tributary.sources import locations as L
from tributary.sources import messages as C
from tributary.sources import pages as P

PAGE_SIZE = 32            # listing page size used by the page fixtures
DAY = "2024-01-15"        # the day read / landed by single-partition queries
OPAQUE_PV = "2023-04-31"  # a partition value that is not a date
RANGE = ("2024-01-25", "2024-02-05")
LOCAL_ROOT = "/data"
AS_OF = "2025-01-15 00:00:00"

# Error names used to exercise the exit-code table -- codes
# 1..21 by name, then four names the table does not know.
ERROR_NAMES = [name for code, name in EXIT_CODES if code > 0] + [
    "Timeout", "Out of Memory", "Disk Full", "Interrupted"]

CUSTOMER_KEYS = T.StructType([T.StructField("c_custkey", T.LongType()),
                              T.StructField("c_name", T.StringType())])
TS_US = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DUCK_TS_US = "%Y-%m-%d %H:%M:%S.%f"
DUCK_TS = "%Y-%m-%d %H:%M:%S"


def _days_out(df: DataFrame) -> DataFrame:
    return df.select("event_id", F.date_format("ts", TS_US).alias("ts"), "user_id", "event_type",
                     "value", "props", "partition_value")


def _days_sql(pv: str) -> str:
    return (f"SELECT event_id, strftime(ts, '{DUCK_TS_US}') AS ts, user_id, event_type, value, props, "
            f"'{pv}' AS partition_value FROM events WHERE strftime(ts, '%Y-%m-%d') = '{pv}'")


def _items(spark, sf):
    return FX.items(spark, sf)


def _details(items: DataFrame) -> DataFrame:
    """Per-item detail documents as the remote service returns them."""
    return items.select(F.to_json(F.struct(F.col("id"), F.col("web").alias("webUrl"))).alias("body"))


# ======================================================== A: locations ====

def q_location_roundtrip(spark, sf):
    locs = {"source_folder": {"type": "directory", "directory_path": work_dir(spark, "roundtrip")}}
    cust = FX.table(spark, sf, "customer").select("c_custkey", "c_name")
    L.write_partition(cust, locs, "source_folder", OPAQUE_PV)
    return L.read_partition(spark, locs, "source_folder", OPAQUE_PV, CUSTOMER_KEYS)


def q_partition_read(spark, sf):
    locs = FX.days_location(spark, sf)
    return _days_out(L.read_partition(spark, locs, "days", DAY, FX.DAYS_SCHEMA))


def q_missing_partitions(spark, sf):
    locs = FX.days_location(spark, sf)
    return L.missing_partitions(spark, locs, "days", L.date_range_values(spark, *RANGE))


def q_partition_write(spark, sf):
    locs = {"days": {"type": "directory", "directory_path": work_dir(spark, "pwrite")}}
    all_days = FX.days(spark, sf)
    L.write_partitions(all_days, locs, "days")
    errors_of_day = all_days.where((F.col("partition_value") == DAY) & (F.col("event_type") == "error"))
    L.write_partitions(errors_of_day, locs, "days")  # replaces that day only
    return (L.read_partitions(spark, locs, "days", FX.DAYS_SCHEMA)
            .groupBy("partition_value").agg(F.count(F.lit(1)).alias("n")))


def q_landing_write(spark, sf):
    src = FX.days_location(spark, sf)
    locs = dict(src, landing={"type": "snowflake_landing_zone",
                              "directory_path": work_dir(spark, "landing")})
    I.land_all(spark, locs, "days", "landing", FX.DAYS_SCHEMA)
    landed = L.landed_partitions(spark, locs, "landing", FX.DAYS_SCHEMA)
    return landed.select("landing_dir", "event_id", F.date_format("ts", TS_US).alias("ts"), "user_id", "event_type", "value", "props")


def q_list_files(spark, sf):
    return L.list_files(spark, FX.text_folder(spark, sf), "txt", recursive=True).select("name", "length")


def q_count_files(spark, sf):
    return L.count_files(spark, FX.text_folder(spark, sf), "txt", recursive=True)


def _odd_orders(spark, sf):
    """Orders by partition values that hold what folder names can't."""
    return FX.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.concat(
        F.col("o_orderpriority"), F.lit(" 50%+a:b")).alias("partition_value"))


def q_partition_names(spark, sf):
    """Opaque partition values through both writers and both readers."""
    orders = _odd_orders(spark, sf)
    schema = orders.drop("partition_value").schema
    locs = {"days": {"type": "directory", "directory_path": work_dir(spark, "names")},
            "landing": {"type": "snowflake_landing_zone", "directory_path": work_dir(spark, "names-landed")}}
    L.write_partitions(orders, locs, "days")
    I.land_all(spark, locs, "days", "landing", schema)
    sets = L.read_partitions(spark, locs, "days", schema).withColumn("kind", F.lit("directory"))
    landed = L.read_partitions(spark, locs, "landing", schema).withColumn("kind", F.lit("landing"))
    return sets.unionByName(landed).select("kind", "partition_value", "o_orderkey", "o_totalprice")


def q_csv_documents(spark, sf):
    """All documents through a CSV step and back."""
    docs = FX.table(spark, sf, "documents").select("doc_id", "text", "lang")
    locs = {n: {"type": "directory", "directory_path": work_dir(spark, n), "null_value": "\\N"}
            for n in ("csv-docs", "csv-out")}
    L.write_partition(docs, locs, "csv-docs", OPAQUE_PV, fmt="csv")
    I.copy_partition(spark, locs, "csv-docs", "csv-out", OPAQUE_PV, docs.schema, fmt="csv")
    return L.read_partition(spark, locs, "csv-out", OPAQUE_PV, docs.schema, fmt="csv")


def q_csv_partition_read(spark, sf):
    locs = {"csv_in": {"type": "directory", "directory_path": work_dir(spark, "csv")}}
    cust = FX.table(spark, sf, "customer")
    key = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("bad"), F.col("c_custkey").cast("string"))) \
           .otherwise(F.col("c_custkey").cast("string"))
    L.write_partition(cust.select(key.alias("c_custkey"), "c_name", "c_nationkey"),
                      locs, "csv_in", OPAQUE_PV, fmt="csv")
    schema = T.StructType([T.StructField("c_custkey", T.LongType()),
                           T.StructField("c_name", T.StringType()),
                           T.StructField("c_nationkey", T.IntegerType())])
    df = L.read_csv_partition(spark, locs, "csv_in", OPAQUE_PV, schema)
    return df.select("c_name", "c_custkey", "c_nationkey",
                     F.col("_corrupt_record").isNotNull().alias("is_corrupt"))


def q_csv_quarantine(spark, sf):
    """A CSV step over all customers: those with a key that is no number go to
    the quarantine, both sides as they were written."""
    folder = lambda n: {"type": "directory", "directory_path": work_dir(spark, n)}
    locs = {"raw": folder("q-raw"), "clean": folder("q-clean"), "rejected": folder("q-rejected")}
    key = F.concat(F.when(F.col("c_acctbal") < 0, "bad").otherwise(""), F.col("c_custkey").cast("string"))
    L.write_partition(FX.table(spark, sf, "customer").select(key.alias("c_custkey"), "c_name", "c_nationkey"), locs, "raw", OPAQUE_PV, fmt="csv")
    schema = T.StructType([*CUSTOMER_KEYS.fields, T.StructField("c_nationkey", T.IntegerType())])
    out = I.copy_partition(spark, locs, "raw", "clean", OPAQUE_PV, schema, fmt="csv", target_fmt="parquet", quarantine="rejected")
    if out["error"] is not None:
        raise out["error"]
    text = T.StructType([T.StructField(I.CORRUPT, T.StringType())])
    clean = L.read_partition(spark, locs, "clean", OPAQUE_PV, schema)
    rejected = L.read_partition(spark, locs, "rejected", OPAQUE_PV, text)
    return clean.select("partition_value", "c_custkey", "c_name", "c_nationkey", F.lit(None).cast("string").alias("rejected")).unionByName(
        rejected.select("partition_value", F.col(I.CORRUPT).alias("rejected")), allowMissingColumns=True).withColumn(
        "n_rows", F.lit(out["n_rows"]).cast("long")).withColumn("n_rejected", F.lit(out["n_rejected"]).cast("long"))


def transport_step(spark, sf, run_log_dir: str | None = None) -> DataFrame:
    src = FX.days_location(spark, sf)
    locs = dict(src, working_folder={"type": "snowflake_landing_zone",
                                     "directory_path": work_dir(spark, "transport")})
    log = D.RunLog(spark, run_log_dir or work_dir(spark, "runlog"), job_name="transport")
    out = I.copy_partition(spark, locs, "days", "working_folder", DAY, FX.DAYS_SCHEMA,
                           run_log=log, step="transport")
    if out["error"] is not None:
        raise out["error"]
    landed = spark.read.schema(FX.DAYS_SCHEMA).parquet(out["target_path"])
    return _days_out(landed.withColumn("partition_value", F.lit(DAY)))


def q_transport_step(spark, sf):
    return transport_step(spark, sf)


# ===================================================== B: remote items ====

def _pages(spark, sf):
    return B.item_pages(_items(spark, sf), PAGE_SIZE)


def q_drive_list(spark, sf):
    return B.drive_list(_pages(spark, sf))


def q_item_listing(spark, sf):
    items = _items(spark, sf)
    return B.item_listing(B.item_pages(items, PAGE_SIZE), _details(items))


def q_item_weburl(spark, sf):
    items = _items(spark, sf)
    return B.attach_web_urls(items.select("id"), B.parse_details(_details(items))).select("id", "url")


def q_item_paths(spark, sf):
    return B.item_paths(_items(spark, sf))


def q_folder_resolve(spark, sf):
    return B.resolve_folder_paths(_items(spark, sf), FX.resolve_requests(spark, sf)) \
            .select("event_id", "path", "folder_id")


def q_tree_walk(spark, sf):
    return B.walk_tree(_items(spark, sf), "root", carry=[]).select(
        "id", "parent_id", "name", "type", "level", "walk_path")


def q_fetch_outcomes(spark, sf):
    docs = FX.table(spark, sf, "documents").select("doc_id")
    content = FX.table(spark, sf, "pages").select((F.col("page_id") * 3).alias("key"), "html")
    return B7.fetch_from_table(docs, content, "doc_id", "key", "html").select(
        "doc_id", "status", "reason", "length")


def q_fetch_by_id(spark, sf):
    return B.fetch_by_id(_items(spark, sf), FX.fetch_requests(spark, sf), LOCAL_ROOT).select(
        "request_id", "file_id", "name", "subfolder", "target_path", "ok")


def q_download_manifest(spark, sf):
    return B.download_manifest(_items(spark, sf), LOCAL_ROOT, "root")


def q_paged_source(spark, sf):
    store = FX.page_store(spark, sf, PAGE_SIZE)
    starts = (_items(spark, sf).select(F.col("parent_id").alias("folder_id")).distinct()
              .withColumn("link", F.concat(F.col("folder_id"), F.lit("-0"))))
    pages = P.follow_pages(starts, P.FilePageStore(store))
    return B.item_rows(pages.where(F.col("error").isNull()))


def q_remote_walk(spark, sf):
    """The whole remote tree listed from ``root`` through the paged service,
    level by level (the re-aimed recursive download listing)."""
    store = FX.page_store(spark, sf, PAGE_SIZE)
    found, _ = B.walk_remote(spark, P.FilePageStore(store), ["root"], link_suffix="-0")
    return found.select("parent_id", "id", "name", "type", "level", "fullpath")


# ========================================================= C: messages ====

def _messages(spark, sf):
    return C.read_messages(spark, FX.mail_folder(spark, sf), recursive=True)


def q_message_table(spark, sf):
    m = _messages(spark, sf)
    return m.select("id", "sender", F.size("recipients").alias("n_recipients"),
                    F.size("cc").alias("n_cc"), F.size("bcc").alias("n_bcc"), "timestamp",
                    F.col("email").alias("email"))


def q_message_sender(spark, sf):
    return C.senders(_messages(spark, sf))


def q_message_recipients(spark, sf):
    return C.recipients_long(_messages(spark, sf))


# ========================================================== D: run log ====

def q_run_log_defaults(spark, sf):
    import uuid
    name = f"tributary_run_log_{uuid.uuid4().hex[:10]}"
    location = work_dir(spark, "logtable")
    D.create_log_table(spark, name, location)
    D.insert_run_ids(spark, name, FX.changes(spark, sf).select("run_id").distinct())
    # The table is external (explicit LOCATION): read its files, then drop the
    # catalog entry so repeated runs leave nothing behind in the metastore.
    rows = spark.read.schema(D.LOG_SCHEMA).parquet(location)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return rows.select("run_id", "created_by", F.col("created_at").isNotNull().alias("has_created_at"))


RUN_ID_REQUESTS_SQL = """
SELECT 'step' || CAST(c_custkey % 10 AS STRING) || '#$' || CAST(c_custkey AS STRING) AS run_id
FROM {customer}
"""


def q_run_log_exists(spark, sf):
    return D.run_counts(FX.changes(spark, sf), FX.run_sql(spark, sf, RUN_ID_REQUESTS_SQL))


UPSERT_BASE_SQL = """
SELECT 'o' || CAST(o_orderkey AS STRING) AS run_id, 'order' AS step_name,
       CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'P' THEN 'QUEUED' ELSE 'RUNNING' END AS status,
       o_orderdate AS start_ts, o_orderpriority AS params,
       CAST(NULL AS STRING) AS error_message
FROM {orders}
"""
# A change of every order: urgent ones failed, high ones lose their parameters, low ones
# parameters and start, the others change nothing; and a new run of every customer.
UPSERT_CHANGES_SQL = """
SELECT 'o' || CAST(o_orderkey AS STRING) AS run_id,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'FAILED' END AS status,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'escalated ' || o_orderpriority END AS error_message,
       CASE o_orderpriority WHEN '2-HIGH' THEN 'params' WHEN '5-LOW' THEN 'params,start_ts' END AS unset
FROM {orders}
UNION ALL
SELECT 'c' || CAST(c_custkey AS STRING), 'QUEUED', CAST(NULL AS STRING), CAST(NULL AS STRING) FROM {customer}
"""


def q_run_log_upsert(spark, sf):
    changes = FX.run_sql(spark, sf, UPSERT_CHANGES_SQL).withColumn(D.CLEARED, F.split("unset", ",")).drop("unset")
    cur = D.upsert(FX.run_sql(spark, sf, UPSERT_BASE_SQL), changes)
    return cur.select("run_id", "step_name", "status", X.ts_text("start_ts").alias("start_ts"),
                      "params", "error_message")


def _order():
    return F.struct("ts", "event_id")


def q_run_log_current(spark, sf):
    cur = D.current_runs(FX.changes(spark, sf), _order())
    return cur.select("run_id", "step_name", "status", "error_message",
                      X.ts_text("start_ts").alias("start_ts"), X.ts_text("end_ts").alias("end_ts"),
                      X.ts_text("last_updated_at").alias("last_updated_at"), "n_changes")


def q_status_counts(spark, sf):
    return D.status_counts(FX.changes(spark, sf))


def q_run_id_parts(spark, sf):
    ids = FX.changes(spark, sf).select("run_id").distinct()
    return ids.select("run_id", X.run_id_step("run_id").alias("step"),
                      X.run_id_suffix("run_id").alias("suffix"))


def q_run_log_live(spark, sf):
    ev = FX.table(spark, sf, "events").select("event_id", D.ttl_from("ts").alias("ttl"))
    return D.live_rows(ev, AS_OF).select("event_id", X.ts_text("ttl").alias("ttl"))


def q_run_duration(spark, sf):
    ev = FX.table(spark, sf, "events")
    g = ev.groupBy("user_id").agg(F.min("ts").alias("s"), F.max("ts").alias("e"))
    return g.select("user_id", X.ts_text("s").alias("start_ts"), X.ts_text("e").alias("end_ts"),
                    D.duration_text("s", "e").alias("duration"))


RUN_GAP = "1 HOUR"


def _error_name(event_id="event_id"):
    return F.element_at(F.array(*[F.lit(n) for n in ERROR_NAMES]), (F.col(event_id) % len(ERROR_NAMES) + 1).cast("int"))


def q_job_summary(spark, sf):
    """A row per run of each step, over all events; failed changes have D10's code."""
    ch = FX.changes(spark, sf).withColumn("error_name", F.when(F.col("status") == "FAILED", _error_name()))
    return D.job_runs(D.exit_codes(ch, "error_name", "code"), RUN_GAP, order=_order(), code="code")


def q_exit_codes(spark, sf):
    ev = FX.table(spark, sf, "events")
    names = F.array(*[F.lit(n) for n in ERROR_NAMES])
    named = ev.select("event_id", F.when(F.col("event_type") == "error",
                                         F.element_at(names, (F.col("event_id") % len(ERROR_NAMES) + 1).cast("int")))
                      .alias("error_name"))
    return D.exit_codes(named, "error_name")


def q_error_payload(spark, sf):
    ev = FX.table(spark, sf, "events").where(F.col("event_type") == "error")
    return D.error_payloads(ev.select("event_id", "props"), "props").select("event_id", "error_message")


# ====================================================== E: step graphs ====

def q_step_edges(spark, sf):
    steps = _items(spark, sf).select(
        F.col("id").alias("name"),
        F.when(F.col("parent_id") != "root", F.col("parent_id")).alias("depends_on"))
    return E.step_edges(steps)


def q_edge_vetting(spark, sf):
    return E.vet_edges(FX.trade(spark, sf))


def q_edge_requests(spark, sf):
    """E2 per request: each line item asks for one trade edge; the first
    request of an edge (by line-item key) is accepted, repeats are
    duplicates, same-nation requests are self loops."""
    req = FX.trade(spark, sf).withColumn(
        "request", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    return E.vet_requests(req, "request").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "src", "dst", "verdict")


def q_step_levels(spark, sf):
    return E.topological_levels(E.accepted_edges(FX.entity_edges(spark, sf)))


def q_cycle_nodes(spark, sf):
    return E.cycle_report(FX.flows(spark, sf))


def q_step_count(spark, sf):
    return E.step_count(FX.entity_edges(spark, sf))


# ==================================================== F: UDF surface ====

def q_named_transform(spark, sf):
    return R.apply_chain(FX.table(spark, sf, "orders"), [
        ("filter_rows", {"condition": "o_orderstatus = 'O'"}),
        ("select_columns", {"columns": ["o_orderkey", "o_custkey", "o_orderpriority"]}),
    ])


def _count_lines(doc_id, text):
    return text.count("\n") + 1


def _lines_unless_sevens(n_chars, text):
    if n_chars % 7 == 0:
        raise ValueError(f"refusing a document of {n_chars} characters")
    return text.count("\n") + 1


def q_guarded_map(spark, sf):
    docs = FX.table(spark, sf, "documents")
    out = M.guarded_map(docs, _lines_unless_sevens, "doc_id", ["n_chars", "text"], T.LongType())
    return out.select(F.col("idx").alias("doc_id"), F.col("value").alias("n_lines"))


def q_retrying_map(spark, sf):
    docs = FX.table(spark, sf, "documents")
    fn = FX.flaky(_count_lines, lambda doc_id, text: doc_id % 5)
    # The failures are injected, not real, so no back-off between tries.
    out = M.retrying_map(docs, fn, "doc_id", ["doc_id", "text"], T.LongType(),
                         max_tries=3, delay_seconds=0)
    return out.select(F.col("idx").alias("doc_id"), "ok", "tries", F.col("value").alias("n_lines"))


def q_observed_write(spark, sf):
    ev = FX.table(spark, sf, "events")
    stats = I.observed_write(ev, work_dir(spark, "observed"),
                             metrics={"n_rows": F.count(F.lit(1)), "max_value": F.max("value")})
    return spark.createDataFrame([(int(stats["n_rows"]), float(stats["max_value"]))],
                                 "n_rows LONG, max_value DOUBLE")


# All days of the events and five that are missing.
INGEST_RANGE = ("2024-01-01", "2024-02-05")


def q_ingest_outcomes(spark, sf):
    src = FX.days_location(spark, sf)
    locs = dict(src, landing={"type": "snowflake_landing_zone",
                              "directory_path": work_dir(spark, "ingest")})
    values = [r[0] for r in L.date_range_values(spark, *INGEST_RANGE).collect()]
    log = D.RunLog(spark, work_dir(spark, "ingest-log"), job_name="ingest")
    out = I.ingest_partitions(spark, locs, "days", "landing", values, FX.DAYS_SCHEMA,
                              policy="continue", run_log=log, concurrent_jobs=4)
    return out.select("seq", "partition_value", "status", "n_rows", "exit_code")


def q_ingest_continue(spark, sf):
    """All days twice with one ledger: a day in the middle fails in the first run,
    which goes on; the second run, under the strict policy, attempts that day alone."""
    src = FX.days_location(spark, sf)
    locs = dict(src, landing={"type": "snowflake_landing_zone", "directory_path": work_dir(spark, "resume")})
    ledger = work_dir(spark, "resume-ledger")
    values = sorted(r[0] for r in L.present_partitions(spark, locs, "days").collect())

    def fails(df):
        return df.where(F.when(F.col(L.PV) == DAY, F.raise_error(F.lit("not today")).cast("boolean")).otherwise(F.lit(True)))

    I.ingest_partitions(spark, locs, "days", "landing", values, FX.DAYS_SCHEMA, policy="continue", transform=fails, concurrent_jobs=4, ledger=ledger)
    I.ingest_partitions(spark, locs, "days", "landing", values, FX.DAYS_SCHEMA, policy="fail", ledger=ledger)
    landed = L.landed_partitions(spark, locs, "landing", FX.DAYS_SCHEMA).groupBy("partition_value").agg(
        F.count(F.lit(1)).alias("n_landed"), F.sum(F.xxhash64(*FX.DAYS_SCHEMA.fieldNames()).cast("decimal(38,0)")).cast("string").alias("hash"))
    same = F.col("content_hash") == F.col("hash")
    return I.ledger_rows(spark, ledger).join(landed, "partition_value", "left").select(
        "partition_value", "attempt", "status", "n_rows", "exit_code", "n_landed", same.alias("same_content"))


# ========================================================== registry ====

QUERIES = {
    "location_roundtrip": q_location_roundtrip,
    "partition_read": q_partition_read,
    "missing_partitions": q_missing_partitions,
    "partition_names": q_partition_names,
    "csv_documents": q_csv_documents,
    "partition_write": q_partition_write,
    "landing_write": q_landing_write,
    "list_files": q_list_files,
    "count_files": q_count_files,
    "csv_partition_read": q_csv_partition_read,
    "transport_step": q_transport_step,
    "drive_list": q_drive_list,
    "item_listing": q_item_listing,
    "item_weburl": q_item_weburl,
    "item_paths": q_item_paths,
    "folder_resolve": q_folder_resolve,
    "tree_walk": q_tree_walk,
    "fetch_outcomes": q_fetch_outcomes,
    "fetch_by_id": q_fetch_by_id,
    "download_manifest": q_download_manifest,
    "message_table": q_message_table,
    "message_sender": q_message_sender,
    "message_recipients": q_message_recipients,
    "run_log_defaults": q_run_log_defaults,
    "run_log_exists": q_run_log_exists,
    "run_log_upsert": q_run_log_upsert,
    "run_log_current": q_run_log_current,
    "status_counts": q_status_counts,
    "run_id_parts": q_run_id_parts,
    "run_log_live": q_run_log_live,
    "run_duration": q_run_duration,
    "job_summary": q_job_summary,
    "exit_codes": q_exit_codes,
    "error_payload": q_error_payload,
    "step_edges": q_step_edges,
    "edge_vetting": q_edge_vetting,
    "edge_requests": q_edge_requests,
    "step_levels": q_step_levels,
    "cycle_nodes": q_cycle_nodes,
    "step_count": q_step_count,
    "named_transform": q_named_transform,
    "guarded_map": q_guarded_map,
    "retrying_map": q_retrying_map,
    "observed_write": q_observed_write,
    "ingest_outcomes": q_ingest_outcomes,
    "ingest_continue": q_ingest_continue,
    "csv_quarantine": q_csv_quarantine,
}


# ============================================================ job runs ====

def q_job_run(spark, sf):
    """The sample two-step job: transport lands a day as CSV, process reads
    the CSV landing and writes it to a directory location."""
    from tributary.plans.jobs import run_job
    src = FX.days_location(spark, sf)
    config = {
        "name": "test job",
        "locations": dict(src,
                          working_folder={"type": "snowflake_landing_zone",
                                          "directory_path": work_dir(spark, "job-landing")},
                          processed={"type": "directory", "directory_path": work_dir(spark, "job-out")}),
        "steps": {
            "transport": {"uses": "copy",
                          "params": {"source": "days", "target": "working_folder",
                                     "target_file_format": "csv"}},
            "process": {"depends_on": "transport", "uses": "copy",
                        "params": {"source": "working_folder", "target": "processed",
                                   "source_file_format": "csv"}},
        },
        "log_path": work_dir(spark, "job-log"),
    }
    out = run_job(spark, config, DAY, FX.DAYS_SCHEMA, policy="fail")
    return out.select("step", "level", "status", "n_rows", "exit_code")




@R.register("reject_error_events")
def _reject_error_events(df: DataFrame) -> DataFrame:
    """A check step: the partition fails when it holds any error event."""
    # A filter predicate is always evaluated (a dropped column would be pruned).
    ok = F.when(F.col("event_type") == "error",
                F.raise_error(F.lit("error events present")).cast("boolean")).otherwise(F.lit(True))
    return df.where(ok)


def q_job_run_blocked(spark, sf):
    """Four steps under the ``continue`` policy: a check fails, the step
    after it is BLOCKED, an independent branch still succeeds."""
    from tributary.plans.jobs import run_job
    src = FX.days_location(spark, sf)
    folder = lambda n: {"type": "directory", "directory_path": work_dir(spark, n)}
    config = {
        "name": "checked job",
        "locations": dict(src, staged=folder("jb-staged"), checked=folder("jb-checked"),
                          published=folder("jb-published"), side=folder("jb-side")),
        "steps": {
            "load": {"uses": "copy", "params": {"source": "days", "target": "staged"}},
            "check": {"uses": "reject_error_events", "depends_on": "load",
                      "params": {"source": "staged", "target": "checked"}},
            "publish": {"uses": "copy", "depends_on": "check",
                        "params": {"source": "checked", "target": "published"}},
            "side": {"uses": "copy", "depends_on": "load",
                     "params": {"source": "staged", "target": "side"}},
        },
        "log_path": work_dir(spark, "jb-log"),
    }
    out = run_job(spark, config, DAY, FX.DAYS_SCHEMA, policy="continue")
    return out.select("step", "level", "status", "n_rows", "exit_code")




# ================================================ stated intent (S1-S7) ====

LINEITEM_CONTRACT = {
    "l_orderkey": {"type": "bigint", "nullable": False},
    "l_quantity": {"type": "double", "min": 1.0, "max": 50.0},
    "l_discount": {"min": 0.0, "max": 0.1},
    "l_tax": {"type": "decimal(12,2)"},
    "l_returnflag": {"values": ["A", "N", "R"]},
    "l_linestatus": {"values": ["O"]},
    "l_shipdate": {"nullable": False},
    "l_comment": {"nullable": True},
}
LINEITEM_RULES = [
    ("qty_positive", "l_quantity > 0"),
    ("discount_range", "l_discount BETWEEN 0 AND 0.1"),
    ("flag_domain", "l_returnflag IN ('A', 'N', 'R')"),
    ("tax_not_above_discount", "l_tax <= l_discount"),
]
ORDERS_RAW_SQL = """
SELECT CAST(o_orderkey AS STRING) AS o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN 'C' ELSE '' END || CAST(o_custkey AS STRING) AS o_custkey,
       CAST(o_totalprice AS STRING) AS o_totalprice,
       o_orderpriority
FROM {orders}
"""


def q_schema_contract(spark, sf):
    from tributary.operators.quality import check_contract
    return check_contract(FX.table(spark, sf, "lineitem"), LINEITEM_CONTRACT)


def q_validation_rules(spark, sf):
    from tributary.operators.quality import check_rules
    return check_rules(FX.table(spark, sf, "lineitem"), LINEITEM_RULES)


def q_normalize_rejects(spark, sf):
    from tributary.operators.quality import normalize, reject_counts
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()),
                           T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_totalprice", T.DoubleType()),
                           T.StructField("o_orderpriority", T.IntegerType())])
    return reject_counts(normalize(FX.run_sql(spark, sf, ORDERS_RAW_SQL), schema))


def q_incremental_load(spark, sf):
    from tributary.streaming.incremental import incremental_load
    staging, target, ckpt = (work_dir(spark, n) for n in ("inc-src", "inc-out", "inc-ckpt"))
    days = FX.days(spark, sf)
    rows = []
    for run, wave in enumerate([F.col("partition_value") <= DAY, F.col("partition_value") > DAY], start=1):
        days.where(wave).drop("partition_value").write.mode("append").parquet(staging)
        got = incremental_load(spark, staging, target, ckpt, FX.DAYS_SCHEMA)
        total = spark.read.parquet(target).count()
        rows.append((run, got["rows"], total))
    return spark.createDataFrame(rows, "run INT, n_new LONG, n_total LONG")


def q_run_log_rotate(spark, sf):
    """Three rotations: of the first half of the month's changes, of the rest, and of nothing."""
    ch = FX.changes(spark, sf)
    log = D.VersionedLog(spark, work_dir(spark, "rotate"), ch.schema)
    first = F.date_format("ts", "yyyy-MM-dd") <= DAY
    for new in (ch.where(first), ch.where(~first), None):
        log.rotate(new, _order())
    both = log.history().withColumn("log", F.lit("history")).unionByName(log.current().withColumn("log", F.lit("current")))
    return both.select("log", "run_id", "status", "error_message", X.ts_text("start_ts").alias("start_ts"),
                       X.ts_text("end_ts").alias("end_ts"), X.ts_text("ts").alias("ts"), "event_id", "user_id")


def q_blocked_steps(spark, sf):
    failed = FX.table(spark, sf, "supplier").where(F.col("s_acctbal") < 0).select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("node"))
    return E.blocked_by_failures(E.accepted_edges(FX.entity_edges(spark, sf)), failed)


QUERIES.update({
    "schema_contract": q_schema_contract,
    "validation_rules": q_validation_rules,
    "normalize_rejects": q_normalize_rejects,
    "incremental_load": q_incremental_load,
    "run_log_rotate": q_run_log_rotate,
    "blocked_steps": q_blocked_steps,
})

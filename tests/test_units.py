"""Edge cases and invariants."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.errors import (ActionNotFound, ClientNotFound, CycleError, InvalidConfigError,
                              InvalidSourceError, exit_code_of)
from tributary.functions import exprs as X
from tributary.functions import maps as M
from tributary.functions import registry as R
from tributary.operators import deps as E
from tributary.operators import fetch as B7
from tributary.operators import items as B
from tributary.operators import runlog as D
from tributary.plans import fixtures as FX
from tributary.plans import ingest as I
from tributary.session import local_path
from tributary.sources import locations as L
from tributary.sources import messages as C
from tributary.sources import pages as P

from .conftest import SF_SMALL


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect()) if cols else sorted(tuple(r) for r in df.collect())


# ------------------------------------------------------------ paths ----

def test_path_expressions(spark):
    df = spark.createDataFrame(
        [("/drives/d0/root:", "A"), ("/drives/d0/root:/X/Y", "B"), ("/drives/d0/elsewhere", "C")],
        "pp STRING, name STRING")
    out = df.select(X.path_after_root("pp").alias("p"), "name").select(
        "p", X.full_path("p", "name").alias("f"), X.subfolder(F.lit("/drives/d0/root:/X/Y")).alias("s"))
    assert rows(out) == sorted([("", "A", "X/Y"), ("/X/Y", "/X/Y/B", "X/Y"), ("", "C", "X/Y")])
    no = spark.range(1).select(X.subfolder(F.lit("/drives/d0/root:")).alias("s")).first()[0]
    assert no == ""


def test_join_local_collapses_slashes(spark):
    v = spark.range(1).select(X.join_local(F.lit("/data/"), F.lit("/A//B/")).alias("p")).first()[0]
    assert v == "/data/A/B"


# ------------------------------------------------------------ pages ----

def _tree(spark, n_files):
    rows_ = [("F1", "root", "Top", "folder", "/drives/d0/root:", None, None)]
    rows_ += [(f"x{i}", "F1", f"file{i}.txt", "file", "/drives/d0/root:/Top", "text/plain",
               f"https://dl/{i}" if i % 2 else None) for i in range(n_files)]
    return spark.createDataFrame(rows_, "id STRING, parent_id STRING, name STRING, type STRING, "
                                        "pp STRING, mime STRING, dl STRING")


def test_paged_listing_follows_every_link(spark, tmp_base):
    items = _tree(spark, 70)
    pages = B.item_pages(items, page_size=32)
    assert pages.where("parent_id = 'F1'").count() == 3          # ceil(70 / 32)
    assert pages.count() == 4                                       # + one root page
    C.write_files(pages.select(F.concat("page_key", F.lit(".json")).alias("n"),
                               F.encode("body", "UTF-8").alias("c")), tmp_base, "n", "c")
    starts = spark.createDataFrame([("F1", "F1-0"), ("root", "root-0")], "folder_id STRING, link STRING")
    got = P.follow_pages(starts, P.FilePageStore(tmp_base))
    assert got.where("error IS NULL").count() == 4
    listed = B.item_rows(got)
    assert listed.count() == 71
    f = listed.where("id = 'x1'").first()
    assert (f.type, f.mimeType, f.uri, f.path, f.fullpath) == (
        "file", "text/plain", "https://dl/1", "/Top", "/Top/file1.txt")
    assert listed.where("id = 'x2'").first().uri == ""            # no download URL -> ''
    top = listed.where("id = 'F1'").first()
    assert (top.type, top.mimeType, top.path, top.fullpath) == ("folder", "", "", "Top")


def test_paged_listing_data_source(spark, tmp_base):
    items = _tree(spark, 40)
    pages = B.item_pages(items, page_size=16)
    C.write_files(pages.select(F.concat("page_key", F.lit(".json")).alias("n"),
                               F.encode("body", "UTF-8").alias("c")), tmp_base, "n", "c")
    spark.dataSource.register(P.PagedListingSource)
    got = (spark.read.format("paged_listing").option("store", tmp_base)
           .option("links", "F1=F1-0,root=root-0").load())
    assert got.where("error IS NULL").count() == 4      # 3 pages for F1, 1 for root
    assert B.item_rows(got).count() == 41


def test_missing_page_becomes_error_row(spark, tmp_base):
    starts = spark.createDataFrame([("F9", "nope-0")], "folder_id STRING, link STRING")
    got = P.follow_pages(starts, P.FilePageStore(tmp_base)).collect()
    assert len(got) == 1 and got[0].error is not None


def test_drive_list_page_without_value(spark):
    pages = spark.createDataFrame([('{"value":[{"id":"d1","name":"Docs"}]}',), ('{"error":"x"}',)], "body STRING")
    assert rows(B.drive_list(pages)) == [("d1", "Docs")]


def test_web_urls_default_empty(spark):
    items = spark.createDataFrame([("a",), ("b",)], "id STRING")
    details = spark.createDataFrame([('{"id":"a","webUrl":"https://w/a"}',), ('{"id":"b"}',)], "body STRING")
    assert rows(B.attach_web_urls(items, B.parse_details(details))) == [("a", "https://w/a"), ("b", "")]


# ---------------------------------------------------------- resolve ----

def test_resolve_missing_segment_file_and_case(spark):
    items = spark.createDataFrame([
        ("A", "root", "Alpha", "folder"), ("B", "A", "Beta", "folder"), ("f", "B", "doc", "file"),
        ("A2", "root", "alpha", "folder")], "id STRING, parent_id STRING, name STRING, type STRING")
    req = spark.createDataFrame([(1, "Alpha/Beta"), (2, "Alpha/Gamma"), (3, "Alpha/Beta/doc"),
                                 (4, "alpha"), (5, "ALPHA"), (6, "Alpha")], "k INT, path STRING")
    got = dict(rows(B.resolve_folder_paths(items, req), "k", "folder_id"))
    assert got == {1: "B", 2: None, 3: None, 4: "A2", 5: None, 6: "A"}


def test_walk_levels_and_cycle_guard(spark):
    items = spark.createDataFrame([
        ("A", "root", "A", "folder"), ("B", "A", "B", "folder"), ("f", "B", "f", "file")],
        "id STRING, parent_id STRING, name STRING, type STRING")
    w = B.walk_tree(items, "root")
    assert rows(w, "id", "level", "walk_path") == [("A", 0, "A"), ("B", 1, "A/B"), ("f", 2, "A/B/f")]
    loop = spark.createDataFrame([("A", "B", "A", "folder"), ("B", "A", "B", "folder")],
                                 "id STRING, parent_id STRING, name STRING, type STRING")
    with pytest.raises(CycleError):
        B.walk_tree(loop, "A")


def test_walk_rows_not_more_than_items(spark):
    items = FX.items(spark, SF_SMALL)
    assert B.walk_tree(items, "root").count() <= items.count()


def test_download_manifest_named_start(spark):
    items = FX.items(spark, SF_SMALL)
    m = B.download_manifest(items, "/data", "ASIA")
    n_asia = items.where("type = 'file' AND pp LIKE '%/root:/ASIA/%'").count()
    assert m.count() == n_asia > 0
    assert m.where("target_path NOT LIKE '/data/ASIA/%'").count() == 0
    assert B.download_manifest(items, "/data", "NOWHERE").count() == 0   # unknown folder -> empty


# ------------------------------------------------------------ fetch ----

def test_fetch_with_injected_fetcher(spark):
    def fetcher(url):
        if url == "boom":
            raise ConnectionError("down")
        return (200, "OK", b"abc") if url.startswith("ok") else (404, "Not Found", None)

    m = spark.createDataFrame([(1, "ok1"), (2, "missing"), (3, "boom")], "id INT, url STRING")
    got = {r.id: (r.status, r.length) for r in B7.fetch_with(m, fetcher, "url").collect()}
    assert got == {1: (200, 3), 2: (404, None), 3: (-1, None)}


# ---------------------------------------------------------- run log ----

def test_ttl_leap_day_and_long_duration(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 29, 10), dt.datetime(2024, 3, 5, 15, 4, 5, 900000))],
                               "s TIMESTAMP_NTZ, e TIMESTAMP_NTZ")
    r = df.select(X.ts_text(D.ttl_from("s")).alias("ttl"), D.duration_text("s", "e").alias("d")).first()
    assert r.ttl == "2025-02-28 10:00:00"
    assert r.d == "125:04:05"


def test_status_domain_and_run_ids(spark):
    df = spark.createDataFrame([("RUNNING",), ("CLICKED",), (None,)], "status STRING")
    assert sorted(r[0] for r in df.select(D.normalize_status()).collect()) == ["RUNNING", "UNKNOWN", "UNKNOWN"]
    r = spark.range(1).select(X.make_run_id(F.lit("transport"), F.lit("u-1")).alias("r")).select(
        "r", X.run_id_step("r"), X.run_id_suffix("r")).first()
    assert tuple(r) == ("transport#$u-1", "transport", "u-1")


def test_upsert_is_idempotent(spark):
    cur = spark.createDataFrame([("r1", "RUNNING", None), ("r2", "RUNNING", None)],
                                "run_id STRING, status STRING, error_message STRING")
    ch = spark.createDataFrame([("r1", "FAILED", "bad"), ("r3", "QUEUED", None)],
                               "run_id STRING, status STRING, error_message STRING")
    once = D.upsert(cur, ch)
    twice = D.upsert(once, ch)
    assert rows(once) == rows(twice) == [("r1", "FAILED", "bad"), ("r2", "RUNNING", None), ("r3", "QUEUED", None)]


def test_run_log_lifecycle_and_defaults(spark, tmp_base):
    log = D.RunLog(spark, tmp_base + "/log", job_name="job")
    a = log.create("transport", {"source": "s"}, partition_value="2023-04-31", start=True)
    log.success(a)
    b = log.create("process", {}, partition_value="2023-04-31")
    log.start(b)
    log.failed(b, "boom")
    cur = {r.run_id: r for r in log.current().collect()}
    assert cur[a].status == "SUCCESS" and cur[a].end_ts is not None and cur[a].partition_value == "2023-04-31"
    assert cur[b].status == "FAILED" and cur[b].error_message == "boom"
    assert cur[a].ttl.year == cur[a].start_ts.year + 1 and cur[a].job_name == "job"
    assert a.startswith("transport#$")
    rep = log.report().first()
    assert (rep.job_name, rep.n_runs, rep.n_failed, rep.exit_code) == ("job", 2, 1, 1)
    assert len(rep.duration.split(":")) == 3
    before = rows(log.current())
    log.compact()
    assert rows(log.current()) == before and log.changes().count() == 2
    log.save(a, status="SKIPPED")
    assert {r.run_id: r.status for r in log.current().collect()}[a] == "SKIPPED"
    far = (dt.datetime.now() + dt.timedelta(days=800)).strftime("%Y-%m-%d %H:%M:%S")
    log.compact(as_of=far)                        # every TTL (1 year) has passed by then
    assert log.current().count() == 0
    name = "t_defaults_test"
    D.create_log_table(spark, name, tmp_base + "/table")
    D.create_log_table(spark, name, tmp_base + "/table")     # IF NOT EXISTS
    D.insert_run_ids(spark, name, spark.createDataFrame([("x",)], "run_id STRING"))
    r = spark.table(name).first()
    assert r.created_by == "system" and r.created_at is not None and r.status is None
    spark.sql(f"DROP TABLE {name}")


def test_exit_codes_and_payload(spark):
    df = spark.createDataFrame([(1, "Invalid Source"), (2, "Weird"), (3, None)], "k INT, err STRING")
    assert rows(D.exit_codes(df, "err"), "k", "exit_code") == [(1, 2), (2, 1), (3, 0)]
    p = spark.range(1).select(X.error_payload(F.lit("x")).alias("j")).first()[0]
    assert p == '{"status":-1,"error":{"message":"x"}}'
    assert exit_code_of(InvalidSourceError("x")) == 2 and exit_code_of(None) == 0


# ------------------------------------------------------------ graph ----

def test_vetting_duplicates_and_self_loops(spark):
    req = spark.createDataFrame([("a", "b"), ("a", "b"), ("c", "c"), ("b", "c")], "src STRING, dst STRING")
    got = rows(E.vet_edges(req), "src", "dst", "verdict", "n_rejected")
    assert got == [("a", "b", "ok", 1), ("b", "c", "ok", 0), ("c", "c", "self_loop", 1)]
    assert E.accepted_edges(req).count() == 2


def test_cycle_with_downstream_node(spark):
    e = spark.createDataFrame([("x", "a"), ("a", "b"), ("b", "c"), ("c", "b"), ("c", "d")],
                              "src STRING, dst STRING")
    levels, remaining = E.peel(e)
    assert rows(levels, "node", "level") == [("a", 1), ("x", 0)]
    assert sorted(r[0] for r in remaining.collect()) == ["b", "c", "d"]
    with pytest.raises(CycleError):
        E.topological_levels(e)
    assert E.has_cycle(e)
    blocked = E.blocked_by_failures(e, spark.createDataFrame([("a",)], "node STRING"))
    assert sorted(r[0] for r in blocked.collect()) == ["b", "c", "d"]


def test_levels_parent_before_child(spark):
    e = E.accepted_edges(FX.entity_edges(spark, SF_SMALL))
    lv = E.topological_levels(e)
    j = (e.join(lv.withColumnRenamed("node", "src").withColumnRenamed("level", "ls"), "src")
          .join(lv.withColumnRenamed("node", "dst").withColumnRenamed("level", "ld"), "dst"))
    assert j.where("ls >= ld").count() == 0
    assert lv.count() == E.step_nodes(None, e).count()


def test_step_edges_from_arrays(spark):
    steps = spark.createDataFrame([("a", None), ("b", ["a"]), ("c", ["a", "b", "a"])],
                                  "name STRING, depends_on ARRAY<STRING>")
    assert rows(E.step_edges(steps)) == [("a", "b"), ("a", "c"), ("b", "c")]


# ------------------------------------------------------- locations ----

def test_location_errors_and_types(spark, tmp_base):
    locs = {"src": {"type": "directory", "directory_path": tmp_base + "/src"},
            "odd": {"type": "ftp", "directory_path": "/x"}}
    schema = T.StructType([T.StructField("a", T.LongType())])
    with pytest.raises(InvalidSourceError) as ei:
        L.read_partition(spark, locs, "src", "2023-04-31", schema)
    assert ei.value.exit_code == 2
    with pytest.raises(InvalidConfigError):
        L.partition_path(locs, "nope", "x")
    with pytest.raises(ClientNotFound):
        L.partition_path(locs, "odd", "x")
    assert set(L.location_types()) >= {"directory", "snowflake_landing_zone"}


def test_partition_value_is_opaque_string(spark, tmp_base):
    locs = {"d": {"type": "directory", "directory_path": tmp_base}}
    df = spark.createDataFrame([(1, "2024-01-15"), (2, "2024-01-16")], "a LONG, partition_value STRING")
    L.write_partitions(df, locs, "d")
    back = L.read_partitions(spark, locs, "d", T.StructType([T.StructField("a", T.LongType())]))
    assert dict(back.dtypes)["partition_value"] == "string"
    # dynamic overwrite replaces only the partitions written
    L.write_partitions(spark.createDataFrame([(9, "2024-01-16")], "a LONG, partition_value STRING"), locs, "d")
    back = L.read_partitions(spark, locs, "d", T.StructType([T.StructField("a", T.LongType())]))
    assert rows(back, "a", "partition_value") == [(1, "2024-01-15"), (9, "2024-01-16")]


def test_landing_writes_only_snowflake_folder(spark, tmp_base):
    locs = {"land": {"type": "snowflake_landing_zone", "directory_path": tmp_base}}
    L.write_partition(spark.createDataFrame([(1,)], "a LONG"), locs, "land", "2023-04-31")
    assert sorted(os.listdir(local_path(tmp_base))) == ["2023-04-31-snowflake"]


def test_count_files_zero_when_no_match(spark):
    assert L.count_files(spark, SF_SMALL, "csv").first()[0] == 0
    locs = FX.days_location(spark, SF_SMALL)
    n = L.count_partition_files(spark, locs, "days", "2024-01-15", "parquet").first()[0]
    assert n >= 1
    assert L.list_partition_files(spark, locs, "days", "2024-01-15", "csv").count() == 0


def test_files_below_many_folders_are_listed_by_tasks(spark, tmp_base, monkeypatch):
    monkeypatch.setattr(C, "FILES_PER_FOLDER", 2)
    files = spark.createDataFrame([(f"{i}.txt", b"x" * i) for i in range(50)] + [("1.csv", b"-"), (".2.txt", b"-")], "n STRING, c BINARY")
    C.write_files(files, tmp_base, "n", "c", in_folders=True)
    found = L.list_files(spark, tmp_base, "txt", recursive=True)
    assert found.rdd.getNumPartitions() > 1
    assert rows(found, "name", "length") == sorted((f"{i}.txt", i) for i in range(50))
    assert found.where("modificationTime > current_timestamp() - INTERVAL 1 HOUR").count() == 50
    assert L.count_files(spark, tmp_base, "txt", recursive=True).first()[0] == 50
    assert L.count_files(spark, tmp_base, "txt").first()[0] == 0           # the folder alone
    assert L.count_files(spark, tmp_base, "pdf", recursive=True).first()[0] == 0
    with pytest.raises(InvalidSourceError):
        L.list_files(spark, tmp_base + "/none", "txt", recursive=True)


# ------------------------------------------------ policy and steps ----

def test_policy_fail_continue_and_missing_source(spark, tmp_base):
    src = FX.days_location(spark, SF_SMALL)
    locs = dict(src, out={"type": "snowflake_landing_zone", "directory_path": tmp_base})

    def bad_on_5(df):
        return df.withColumn("x", F.when(F.col("partition_value") == "2024-01-05",
                                         F.raise_error(F.lit("bad day"))).otherwise(F.lit(1)))

    vals = ["2024-01-04", "2024-01-05", "2024-01-06", "2024-01-31", "2024-01-07"]
    fail = I.ingest_partitions(spark, locs, "days", "out", vals, FX.DAYS_SCHEMA, "fail", transform=bad_on_5)
    assert [r.status for r in fail.orderBy("seq").collect()] == ["SUCCESS", "FAILED"]
    cont = I.ingest_partitions(spark, locs, "days", "out", vals, FX.DAYS_SCHEMA, "continue", transform=bad_on_5)
    got = [(r.partition_value, r.status, r.exit_code) for r in cont.orderBy("seq").collect()]
    assert got == [("2024-01-04", "SUCCESS", 0), ("2024-01-05", "FAILED", 1),
                   ("2024-01-06", "SUCCESS", 0), ("2024-01-31", "FAILED", 2)]


def test_success_logged_only_after_write(spark, tmp_base):
    src = FX.days_location(spark, SF_SMALL)
    locs = dict(src, out={"type": "directory", "directory_path": tmp_base + "/o"})
    log = D.RunLog(spark, tmp_base + "/log")
    boom = lambda df: df.withColumn("x", F.raise_error(F.lit("kaput")))
    out = I.copy_partition(spark, locs, "days", "out", "2024-01-03", FX.DAYS_SCHEMA, transform=boom, run_log=log)
    assert out["status"] == "FAILED"
    cur = log.current().first()
    assert cur.status == "FAILED" and "kaput" in cur.error_message
    ok = I.copy_partition(spark, locs, "days", "out", "2024-01-03", FX.DAYS_SCHEMA, run_log=log)
    done = log.current().where(F.col("run_id") == ok["run_id"]).first()
    assert done.status == "SUCCESS" and done.log_path == ok["target_path"]


# --------------------------------------------------------- row maps ----

def test_guarded_and_retrying_maps(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(6)], "k LONG, t STRING")

    def f(k, t):
        if k == 3:
            raise ValueError("three")
        return [len(t) + k]

    g = M.guarded_map(df, f, "k", ["k", "t"], T.LongType(), ordered=True)
    assert [(r.idx, r.value) for r in g.collect()] == [(0, 2), (1, 3), (2, 4), (4, 6), (5, 7)]
    fl = FX.flaky(lambda k, t: k, lambda k, t: k % 4)
    r = {x.idx: (x.ok, x.tries) for x in M.retrying_map(df, fl, "k", ["k", "t"], T.LongType(),
                                                          max_tries=3, delay_seconds=0).collect()}
    assert r == {0: (True, 1), 1: (True, 2), 2: (True, 3), 3: (False, 3), 4: (True, 1), 5: (True, 2)}


def test_named_transform_registry(spark):
    with pytest.raises(ActionNotFound):
        R.get("no_such_action")

    @R.register("double_a")
    def _d(df):
        return df.withColumn("a", F.col("a") * 2)

    df = spark.createDataFrame([(1,)], "a INT")
    assert R.apply(df, "double_a").first().a == 2
    R.register("double_a")(lambda df: df)   # replaced (with a warning)
    assert R.apply(df, "double_a").first().a == 1


# --------------------------------------------------------- messages ----

def test_messages_malformed_and_no_recipients(spark, tmp_base):
    files = spark.createDataFrame([
        ("1.eml", b"From: a@x.org\r\nDate: 01 Jan 2024 00:00:00 +0000\r\n\r\nhi\r\n"),
        ("2.eml", b"From: b@x.org\r\nTo: c@x.org, d@x.org\r\nBcc: e@x.org\r\nDate: nonsense\r\n\r\nyo\r\n"),
    ], "n STRING, c BINARY")
    C.write_files(files, tmp_base, "n", "c")
    m = C.read_messages(spark, tmp_base)
    got = {r.id: r for r in m.collect()}
    assert got[1].recipients == [] and got[1].timestamp == 1704067200 and got[1].email == "hi"
    assert got[2].error is not None                      # bad date: row kept, reason given
    long = rows(C.recipients_long(m.where("id = 1")), "id", "pos", "recipient")
    assert long == [(1, None, None)]


def test_messages_dealt_over_folders(spark, tmp_base, monkeypatch):
    monkeypatch.setattr(C, "FILES_PER_FOLDER", 7)
    monkeypatch.setattr(C, "FILES_PER_TASK", 10)
    files = spark.createDataFrame(
        [(f"{i}.eml", f"From: a{i}@x.org\r\nTo: b@x.org\r\n\r\nbody {i}\r\n".encode()) for i in range(60)]
        + [("7.eml", b"From: a7@x.org\r\nTo: b@x.org\r\n\r\nbody 7\r\n"), ("no.txt", b"-"), ("_8.eml", b"-")], "n STRING, c BINARY")
    assert C.write_files(files, tmp_base, "n", "c", in_folders=True)[0] == 63
    assert len(os.listdir(local_path(tmp_base))) > 4
    C.write_files(spark.createDataFrame([("60.eml", b"From: a60@x.org\r\n\r\nbody 60\r\n")], "n STRING, c BINARY"), tmp_base, "n", "c")
    m = C.read_messages(spark, tmp_base, recursive=True)
    assert m.rdd.getNumPartitions() == 7                 # 61 files, 10 a task
    assert rows(m, "id", "sender", "email") == [(i, f"a{i}@x.org", f"body {i}") for i in range(61)]
    assert m.where(F.expr("path NOT LIKE concat('%/', id, '.eml')")).count() == 0


def test_normalize_matches_try_cast(spark):
    from tributary.operators.quality import normalize
    vals = ["1.0", " 7 ", "+3", "-4", "1e3", "0x10", "１２", "12.5", "\t8\n", "99999999999",
            "", " ", "1_000", "007", "3.", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k INT, s STRING")
    schema = T.StructType([T.StructField("s", T.IntegerType())])
    got = {r.k: (r.s, r._rejected) for r in normalize(df.withColumnRenamed("s", "s"), schema, key="k").collect()}
    want = {r.k: r.v for r in df.selectExpr("k", "try_cast(s AS INT) v").collect()}
    assert {k: v[0] for k, v in got.items()} == want
    assert got[15] == (None, [])             # NULL in, NULL out, not a reject
    assert got[4] == (None, ["s"])           # present but not convertible


def test_present_partitions_keeps_values_exact(spark, tmp_base):
    locs = {"d": {"type": "directory", "directory_path": tmp_base + "/h"},
            "p": {"type": "directory", "directory_path": tmp_base + "/p", "layout": "plain"}}
    odd = ["a/b:c+d 2", "50%=x", "007", "2023-04-31"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(odd)], "a LONG, partition_value STRING")
    L.write_partitions(df, locs, "d")
    assert sorted(r[0] for r in L.present_partitions(spark, locs, "d").collect()) == sorted(odd)
    for pv in ["007", "2023-04-31"]:
        L.write_partition(df.where(F.col("partition_value") == pv), locs, "p", pv)
    assert sorted(r[0] for r in L.present_partitions(spark, locs, "p").collect()) == ["007", "2023-04-31"]
    req = L.requested_values(spark, ["007", "008"])
    assert [r[0] for r in L.missing_partitions(spark, locs, "p", req).collect()] == ["008"]


def test_one_outcome_per_partition_and_concurrency_agrees(spark, tmp_base):
    src = FX.days_location(spark, SF_SMALL)
    locs = dict(src, out={"type": "snowflake_landing_zone", "directory_path": tmp_base})
    vals = [f"2024-01-{d:02d}" for d in range(1, 11)]
    seq = I.ingest_partitions(spark, locs, "days", "out", vals, FX.DAYS_SCHEMA, "continue")
    par = I.ingest_partitions(spark, locs, "days", "out", vals, FX.DAYS_SCHEMA, "continue", concurrent_jobs=4)
    a = rows(seq, "seq", "partition_value", "status", "n_rows")
    assert a == rows(par, "seq", "partition_value", "status", "n_rows")
    assert [r[1] for r in a] == vals and all(r[2] == "SUCCESS" for r in a)
    counts = dict(rows(FX.days(spark, SF_SMALL).groupBy("partition_value").count()))
    assert all(r[3] == counts[r[1]] for r in a)


def test_item_pages_stay_bounded_for_a_hot_folder(spark):
    # one folder holding a large share of all items: pages stay near page_size
    items = _tree(spark, 3000)
    sizes = (B.item_pages(items, page_size=100)
             .select(F.size(F.from_json("body", B.PAGE_SCHEMA)["value"]).alias("n")))
    r = sizes.agg(F.max("n"), F.sum("n"), F.count(F.lit(1))).first()
    assert r[1] == 3001 and r[2] == 31 and r[0] <= 160


def test_job_runs_block_skip_and_cycles(spark, tmp_base):
    from tributary.plans.jobs import job_exit_code, run_job
    src = FX.days_location(spark, SF_SMALL)
    locs = dict(src, a={"type": "directory", "directory_path": tmp_base + "/a"},
                b={"type": "directory", "directory_path": tmp_base + "/b"})
    ddl = "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, props STRING"
    cfg = {"name": "j", "locations": locs, "log_path": tmp_base + "/log", "steps": {
        "load": {"uses": "copy", "params": {"source": "days", "target": "a", "schema": ddl}},
        "broken": {"uses": "no_such_action", "depends_on": "load",
                   "params": {"source": "a", "target": "b", "schema": ddl}},
        "after_broken": {"uses": "copy", "depends_on": ["broken"],
                         "params": {"source": "b", "target": "a", "schema": ddl}},
        "side": {"uses": "copy", "depends_on": "load",
                 "params": {"source": "a", "target": "b", "schema": ddl}},
    }}
    out = {r.step: (r.level, r.status, r.exit_code) for r in
           run_job(spark, cfg, "2024-01-02", policy="continue").collect()}
    assert out["load"] == (0, "SUCCESS", 0)
    assert out["broken"][1:] == ("FAILED", 4)
    assert out["side"][1] == "SUCCESS" and out["after_broken"][1] == "BLOCKED"
    fail = run_job(spark, cfg, "2024-01-03", policy="fail")
    statuses = {r.step: r.status for r in fail.collect()}
    assert statuses["broken"] == "FAILED" and statuses["after_broken"] in ("SKIPPED", "BLOCKED")
    assert job_exit_code(fail).first()[0] == 4
    cyc = {"locations": locs, "steps": {"x": {"depends_on": "y"}, "y": {"depends_on": "x"}}}
    with pytest.raises(CycleError):
        run_job(spark, cyc, "2024-01-02")


def test_empty_source_is_skipped(spark, tmp_base):
    locs = {"s": {"type": "directory", "directory_path": tmp_base + "/s"},
            "t": {"type": "directory", "directory_path": tmp_base + "/t"}}
    schema = T.StructType([T.StructField("a", T.LongType())])
    L.write_partition(spark.createDataFrame([], schema), locs, "s", "p1")
    out = I.copy_partition(spark, locs, "s", "t", "p1", schema, skip_empty=True)
    assert out["status"] == "SKIPPED" and out["n_rows"] == 0


def test_download_manifest_to_folder(spark, tmp_base):
    items = FX.items(spark, SF_SMALL)
    root = local_path(tmp_base)
    manifest = B.download_manifest(items, root, "EUROPE")

    def fetcher(url):
        if not url:
            return 404, "no download url", None
        return 200, "OK", url.encode()

    out = B7.fetch_to_folder(manifest, fetcher, "uri", "target_path").collect()
    ok = [r for r in out if r.status == 200]
    assert ok and len(ok) + sum(r.status == 404 for r in out) == len(out)
    sample = ok[0]
    with open(sample.target_path, "rb") as fh:
        assert fh.read() == sample.uri.encode()
    assert sample.target_path.startswith(root + "/EUROPE/")


def test_walk_remote_lists_levels_and_reports_errors(spark, tmp_base):
    items = spark.createDataFrame([
        ("A", "root", "A", "folder", "/d/root:", None, None),
        ("B", "A", "B", "folder", "/d/root:/A", None, None),
        ("Z", "A", "Z", "folder", "/d/root:/A", None, None),
        ("f", "B", "f.txt", "file", "/d/root:/A/B", "text/plain", "https://dl/f")],
        "id STRING, parent_id STRING, name STRING, type STRING, pp STRING, mime STRING, dl STRING")
    pages = B.item_pages(items, page_size=1)
    C.write_files(pages.select(F.concat("page_key", F.lit(".json")).alias("n"),
                               F.encode("body", "UTF-8").alias("c")), tmp_base, "n", "c")
    found, errors = B.walk_remote(spark, P.FilePageStore(tmp_base), ["root"], link_suffix="-0")
    got = rows(found, "parent_id", "id", "level", "fullpath")
    assert got == [("A", "B", 1, "/A/B"), ("A", "Z", 1, "/A/Z"), ("B", "f", 2, "/A/B/f.txt"),
                   ("root", "A", 0, "A")]
    assert errors.count() == 0          # the empty folder Z answers with an empty page


def test_command_line_runs_a_yaml_job(spark, tmp_base):
    from tributary.__main__ import main
    src = FX.days_location(spark, SF_SMALL)["days"]["directory_path"]
    cfg = local_path(tmp_base) + "/job.yaml"
    os.makedirs(local_path(tmp_base), exist_ok=True)
    with open(cfg, "w") as fh:
        fh.write(f"""
name: test job
log_path: {tmp_base}/log
locations:
  source_folder: {{type: directory, directory_path: "{src}"}}
  working_folder: {{type: snowflake_landing_zone, directory_path: "{tmp_base}/land"}}
steps:
  transport:
    uses: copy
    params:
      source: source_folder
      target: working_folder
      schema: "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, props STRING"
""")
    assert main([cfg, "2024-01-05"]) == 0
    assert main([cfg, "2024-02-30"]) == 2      # missing source partition


def test_vet_requests_per_request(spark):
    req = spark.createDataFrame([(3, "a", "b"), (1, "a", "b"), (2, "c", "c"), (4, "b", "c"), (5, "a", "b")],
                                "k INT, src STRING, dst STRING")
    got = rows(E.vet_requests(req, "k"), "k", "verdict")
    assert got == [(1, "ok"), (2, "self_loop"), (3, "duplicate"), (4, "ok"), (5, "duplicate")]


def test_looping_next_links_end_with_an_error(spark):
    def get_page(link):
        nxt = {"p0": "p1", "p1": "p0"}[link]
        return '{"value": [], "@odata.nextLink": "%s"}' % nxt

    starts = spark.createDataFrame([("F", "p0")], "folder_id STRING, link STRING")
    got = P.follow_pages(starts, get_page).orderBy("page_no").collect()
    assert [r.page_no for r in got] == [0, 1, 2] and got[-1].error.startswith("next link repeats")


def test_task_retries_leave_exact_outputs(tmp_path):
    import subprocess
    import sys as _sys
    probe = os.path.join(os.path.dirname(__file__), "retry_probe.py")
    out = subprocess.run([_sys.executable, probe, str(tmp_path)], capture_output=True, text=True,
                         timeout=300)
    last = [ln for ln in out.stdout.splitlines() if ln.strip()][-1].split()
    # 200 files written once each despite failed first attempts; 100 downloads
    assert last == ["200", "200", "100", str(sum(len(str(i)) for i in range(100))), "100"]



def test_incremental_load_takes_each_file_once(spark, tmp_base):
    from tributary.streaming.incremental import incremental_load
    src, out, ckpt = tmp_base + "/src", tmp_base + "/out", tmp_base + "/ckpt"
    schema = T.StructType([T.StructField("a", T.LongType())])
    spark.range(5).toDF("a").write.mode("append").parquet(src)
    assert incremental_load(spark, src, out, ckpt, schema)["rows"] == 5
    assert incremental_load(spark, src, out, ckpt, schema)["rows"] == 0     # nothing new
    spark.range(5, 8).toDF("a").write.mode("append").parquet(src)
    assert incremental_load(spark, src, out, ckpt, schema)["rows"] == 3
    assert sorted(r.a for r in spark.read.parquet(out).collect()) == list(range(8))


ODD_VALUES = ["a b+c:d", "50%", "x=y/z", "q?[r]{s}*", "2023-04-31", "%41"]


@pytest.mark.parametrize("cfg", [{"type": "directory"}, {"type": "directory", "layout": "plain"},
                                 {"type": "snowflake_landing_zone"}])
def test_partition_names_round_trip(spark, tmp_base, cfg):
    schema = T.StructType([T.StructField("x", T.LongType())])
    locs = {"a": dict(cfg, directory_path=tmp_base + "/a")}
    for i, pv in enumerate(ODD_VALUES):
        L.write_partition(spark.createDataFrame([(i,)], schema), locs, "a", pv)
        assert [tuple(r) for r in L.read_partition(spark, locs, "a", pv, schema).collect()] == [(i, pv)]
    L.write_partition(spark.createDataFrame([], schema), locs, "a", "empty")
    want = sorted((i, pv) for i, pv in enumerate(ODD_VALUES))
    assert rows(L.read_partitions(spark, locs, "a", schema), "x", "partition_value") == want
    assert sorted(r[0] for r in L.present_partitions(spark, locs, "a").collect()) == sorted([*ODD_VALUES, "empty"])
    asked = L.requested_values(spark, [*ODD_VALUES, "empty", "absent"])
    assert [r[0] for r in L.missing_partitions(spark, locs, "a", asked).collect()] == ["absent"]


def test_set_writer_and_landing_agree_on_names(spark, tmp_base):
    schema = T.StructType([T.StructField("x", T.LongType())])
    locs = {"h": {"type": "directory", "directory_path": tmp_base + "/h"},
            "z": {"type": "snowflake_landing_zone", "directory_path": tmp_base + "/z"}}
    df = spark.createDataFrame(list(enumerate(ODD_VALUES)), "x LONG, partition_value STRING")
    L.write_partitions(df, locs, "h")
    for i, pv in enumerate(ODD_VALUES):
        assert [r.x for r in L.read_partition(spark, locs, "h", pv, schema).collect()] == [i]
    assert I.land_all(spark, locs, "h", "z", schema) == sorted(ODD_VALUES)
    assert rows(L.landed_partitions(spark, locs, "z", schema), "x", "partition_value") == sorted(enumerate(ODD_VALUES))


def test_ingest_outcomes_do_not_depend_on_layout_or_concurrency(spark, tmp_base):
    src = FX.days_location(spark, SF_SMALL)
    locs = dict(src, a={"type": "snowflake_landing_zone", "directory_path": tmp_base + "/a"},
                p={"type": "directory", "layout": "plain", "directory_path": tmp_base + "/p"},
                h={"type": "directory", "directory_path": tmp_base + "/h"})
    vals = ["2024-01-28", "2024-01-29", "2024-01-30", "2024-01-31", "2024-02-01"]
    cols = ("seq", "partition_value", "status", "n_rows", "exit_code")
    loop = rows(I.ingest_partitions(spark, locs, "days", "a", vals, FX.DAYS_SCHEMA, "continue"), *cols)
    log = D.RunLog(spark, tmp_base + "/log")
    four = rows(I.ingest_partitions(spark, locs, "days", "p", vals, FX.DAYS_SCHEMA, "continue",
                                    concurrent_jobs=4, run_log=log), *cols)
    assert loop == four and loop[-1][2:] == ("FAILED", None, 2)
    assert log.current().where("status = 'SUCCESS'").count() == 3
    # a landing zone and a plain folder are sources like any other
    on = rows(I.ingest_partitions(spark, locs, "a", "h", vals, FX.DAYS_SCHEMA, "continue"), *cols)
    assert on == loop == rows(I.ingest_partitions(spark, locs, "p", "h", vals, FX.DAYS_SCHEMA, "continue"), *cols)

    def bad_on_29(df):
        return df.withColumn("x", F.when(F.col("partition_value") == "2024-01-29",
                                         F.raise_error(F.lit("bad day"))).otherwise(F.lit(1)))

    fb = rows(I.ingest_partitions(spark, locs, "days", "a", vals, FX.DAYS_SCHEMA, "continue",
                                  transform=bad_on_29), "partition_value", "status")
    assert fb == [("2024-01-28", "SUCCESS"), ("2024-01-29", "FAILED"), ("2024-01-30", "SUCCESS"),
                  ("2024-01-31", "FAILED")]
    # a second run that keeps nothing empties the target
    none = rows(I.ingest_partitions(spark, locs, "days", "h", vals[:2], FX.DAYS_SCHEMA, "continue",
                                    transform=lambda d: d.where("false")), "status", "n_rows")
    assert none == [("SUCCESS", 0), ("SUCCESS", 0)]
    assert L.read_partition(spark, locs, "h", vals[0], FX.DAYS_SCHEMA).count() == 0


def test_csv_steps_lose_nothing(spark, tmp_base):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.StringType())])
    data = [(1, "two\nlines"), (2, 'a "quote", b'), (3, ""), (4, None), (5, " spaces "), (6, "back\\slash\\"), (7, "é\t,")]
    locs = {n: {"type": "directory", "directory_path": f"{tmp_base}/{n}", "null_value": "\\N"} for n in "ab"}
    L.write_partition(spark.createDataFrame(data, schema), locs, "a", "p", fmt="csv")
    out = I.copy_partition(spark, locs, "a", "b", "p", schema, fmt="csv")
    assert out["n_rows"] == len(data)
    assert sorted((r.k, r.t) for r in L.read_partition(spark, locs, "b", "p", schema, fmt="csv").collect()) == data


def test_a_failing_pointer_read_is_an_error(spark, tmp_base, monkeypatch):
    log = D.RunLog(spark, tmp_base + "/log")
    log.create("s", {})

    class Broken:
        def open_input_stream(self, _):
            raise TimeoutError("store is slow")

    monkeypatch.setattr(log, "_pointer", lambda: (Broken(), "x"))
    with pytest.raises(TimeoutError):
        log.changes()


def test_two_changes_of_a_key_in_one_batch(spark):
    cur = spark.createDataFrame([("r", "RUNNING", None)], "run_id STRING, status STRING, error_message STRING")
    new = spark.createDataFrame([("r", "SUCCESS", None, 2), ("r", "FAILED", "boom", 1), ("n", "QUEUED", None, 1)],
                                "run_id STRING, status STRING, error_message STRING, at LONG")
    got = rows(D.upsert(cur, new, order=F.col("at")), "run_id", "status", "error_message")
    assert got == [("n", "QUEUED", None), ("r", "SUCCESS", "boom")]


def test_incremental_rows_of_many_batches(spark, tmp_base):
    from tributary.streaming.incremental import incremental_load
    src, out, ckpt = (f"{tmp_base}/{n}" for n in ("in", "out", "ckpt"))
    spark.range(120).repartition(120).write.parquet(src)
    got = incremental_load(spark, src, out, ckpt, T.StructType([T.StructField("id", T.LongType())]), max_files_per_trigger=1)
    assert got["rows"] == 120 == spark.read.parquet(out).count()


def test_checks_of_nothing_are_zero(spark):
    from tributary.operators.quality import check_contract, check_rules
    df = spark.createDataFrame([], "k INT")
    assert check_rules(df, [("r", "k > 0")]).first()[1:] == (0, 0, 0)
    assert check_contract(df, {"k": {"nullable": False}, "x": {}}).agg(F.sum("n_violations")).first()[0] == 0


def test_maps_and_fetches_keep_integers_and_nulls(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big, big, "a"), (big + 2, None, "b")], "k LONG, n LONG, u STRING")
    got = sorted(tuple(r)[:4] for r in M.guarded_map(df, lambda n: -1 if n is None else n + 1, "k", ["n"], T.LongType()).collect())
    assert got == [(big, True, 1, big + 1), (big + 2, True, 1, -1)]
    out = sorted((r.k, r.n, r.status, r.content) for r in B7.fetch_with(df, lambda u: (200, "OK", u.encode()), "u").collect())
    assert out == [(big, big, 200, b"a"), (big + 2, None, 200, b"b")]


def test_closed_runs_and_exit_codes_in_the_summary(spark):
    runs = spark.createDataFrame([("a", "SUCCESS", 0), ("a", "SKIPPED", 0), ("b", "FAILED", 2), ("b", "BLOCKED", 0), ("c", "QUEUED", 0)],
                                 "step_name STRING, status STRING, code INT").withColumn("start", F.timestamp_seconds(F.lit(0)).cast("timestamp_ntz")).withColumn("end", F.col("start"))
    assert rows(D.job_summary(runs, code="code"), "step_name", "exit_code") == [("a", 0), ("b", 2), ("c", -1)]


def test_fetches_use_more_than_one_task(spark):
    m = spark.range(300).select(F.concat(F.lit("u"), "id").alias("url")).coalesce(1)
    out = B7.fetch_with(m, lambda u: (200, "OK", u.encode()), "url")
    tasks = out.withColumn("task", F.spark_partition_id()).select("task").distinct().count()
    assert tasks >= 4 and out.count() == 300


def test_contract_and_rules_edge_cases(spark):
    from tributary.operators.quality import check_contract, check_rules
    df = spark.createDataFrame([(1, "ab1", None), (2, "zz", 5.0), (None, None, -1.0)],
                               "k INT, code STRING, v DOUBLE")
    got = {(r.column, r.rule): r.n_violations for r in check_contract(df, {
        "k": {"type": "int", "nullable": False},
        "code": {"pattern": "^[a-z]{2}[0-9]$", "values": ["ab1", "zz"]},
        "v": {"type": "bigint", "min": 0.0},
        "gone": {"nullable": True},
    }).collect()}
    assert got == {("k", "type"): 0, ("k", "not_null"): 1, ("code", "values"): 0,
                   ("code", "pattern"): 1, ("v", "type"): 3, ("v", "min"): 1, ("gone", "missing"): 3}
    r = {x.rule: (x.n_pass, x.n_fail, x.n_unknown) for x in
         check_rules(df, [("positive", "v > 0"), ("has_code", "code IS NOT NULL")]).collect()}
    assert r == {"positive": (1, 1, 1), "has_code": (2, 1, 0)}


def test_fetch_and_pages_stream_in_chunks(spark):
    m = spark.createDataFrame([(i, f"ok{i}") for i in range(7)], "id INT, url STRING")
    got = B7.fetch_with(m.coalesce(1), lambda u: (200, "OK", b"x" * 10), "url", flush_bytes=25).collect()
    assert sorted(r.id for r in got) == list(range(7)) and all(r.length == 10 for r in got)

    def get_page(link):
        n = int(link[1:])
        nxt = f"p{n + 1}" if n < 9 else None
        return '{"value": []' + (f', "@odata.nextLink": "{nxt}"' if nxt else "") + "}"

    starts = spark.createDataFrame([("F", "p0")], "folder_id STRING, link STRING")
    pages = P.follow_pages(starts, get_page, flush_pages=3).collect()
    assert sorted(r.page_no for r in pages) == list(range(10))


def test_salted_joins_equal_plain_joins(spark):
    items = FX.items(spark, SF_SMALL)
    hot = spark.createDataFrame([(i, "C1" if i % 3 else f"C{i}") for i in range(300)],
                                "request_id INT, file_id STRING")      # one id holds 2/3 of the rows
    cols = ("request_id", "file_id", "target_path", "ok")
    assert rows(B.fetch_by_id(items, hot, "/d"), *cols) == rows(B.fetch_by_id(items, hot, "/d", salt_buckets=8), *cols)
    ids = spark.createDataFrame([("step1#$1",)] * 50 + [("nope",)], "run_id STRING")
    ch = FX.changes(spark, SF_SMALL)
    assert rows(D.run_counts(ch, ids)) == rows(D.run_counts(ch, ids, salt_buckets=4))
    req = spark.createDataFrame([(i, "ASIA/CHINA" if i % 2 else "EUROPE/FRANCE") for i in range(40)],
                                "k INT, path STRING")
    assert rows(B.resolve_folder_paths(items, req), "k", "folder_id") == \
        rows(B.resolve_folder_paths(items, req, salt_buckets=5), "k", "folder_id")


def test_readme_quick_start_runs(spark, tmp_base, capsys):
    import re
    readme = open(os.path.join(os.path.dirname(os.path.dirname(__file__)), "README.md")).read()
    code = re.search(r"```python\n(from tributary import build_session.*?)```", readme, re.S).group(1)
    code = code.replace('"/data/', f'"{tmp_base}/')
    exec(code, {})
    out = capsys.readouterr().out.strip().splitlines()[-1].split()
    assert out[:2] == ["SUCCESS", "1"] and out[2].endswith("/land/2023-04-31-snowflake")


# -------------------------------------------------------- split CSV ----

@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_csv_file_is_read_by_many_tasks(spark, tmp_base, small_splits):
    from tributary.sources import csvsplit
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.StringType())])
    nasty = ["plain", 'say "x"', "two\nlines", '"\n"\n,"', "", None, ",", "\n\n\n", "é\n" * 60, "x" * 900, '""', "a\rb", " padded ", '"' * 7 + "\n" + '"' * 4]
    data = [(i, nasty[i % len(nasty)]) for i in range(300)]
    locs = {"a": {"type": "directory", "directory_path": tmp_base, "null_value": "\\N"}}
    path = L.write_partition(spark.createDataFrame(data, schema).coalesce(1), locs, "a", "p", fmt="csv")
    assert len([f for f in L.list_files(spark, path, "csv").collect()]) == 1
    assert csvsplit._lines(spark, path).rdd.getNumPartitions() > 20
    got = sorted((r.k, r.t) for r in L.read_partition(spark, locs, "a", "p", schema, fmt="csv").collect())
    few, many = (sorted(map(tuple, csvsplit.records(spark, path, small).collect())) for small in (10_000, 0))
    assert few == many and len(few) == len(data) + 1   # both ways to put records together
    whole = dict(locs["a"], split=False)
    assert got == data == sorted((r.k, r.t) for r in L.read_partition(spark, {"a": whole}, "a", "p", schema, fmt="csv").collect())


def test_split_csv_edges(spark, tmp_base):
    import os

    from tributary.session import local_path
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.StringType())])
    folder = local_path(tmp_base) + "/partition_value=p"
    os.makedirs(folder)
    for name, text in (("1.csv", "k,t\n"), ("2.csv", ""), ("3.csv", "k,t\n1,a\n\n2,b"), ("4.csv", 'k,t\nbad,x\n3,"never\nclosed\n4,d\n'), ("5.csv", '"k\nk",t\n5,"e\ne"')):
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
    rows = L.read_csv_partition(spark, {"a": {"type": "directory", "directory_path": tmp_base}}, "a", "p", schema).collect()
    assert {(r.k, r.t) for r in rows if r._corrupt_record is None or r.k == 3} >= {(1, "a"), (2, "b"), (5, "e\ne")}
    assert len(rows) == 5 and [r._corrupt_record for r in rows if r.t == "x"] == ["bad,x"]


# ------------------------------------------- run log: NULLs, versions ----

def test_cleared_columns_become_null_and_can_be_set_again(spark, tmp_base):
    log = D.RunLog(spark, tmp_base + "/log", job_name="j")
    run = log.create("s", {"a": 1}, partition_value="p")
    log.save(run, cleared=["params", "partition_value"])
    log.save(run, partition_value="q")
    row = log.current().first()
    assert (row.params, row.partition_value, row.job_name) == (None, "q", "j")
    log.compact()
    log.save(run, cleared=["partition_value"])
    row = log.current().first()
    assert (row.params, row.partition_value, row.job_name) == (None, None, "j")


def test_changes_appended_during_a_compaction_stay(spark, tmp_base, monkeypatch):
    log = D.RunLog(spark, tmp_base + "/log", job_name="j")
    a, b = log.create("a", {}), log.create("b", {})
    switch = D.write_pointer

    def late(path, state):  # between the fold and the switch
        log.success(a)
        switch(path, state)

    monkeypatch.setattr(D, "write_pointer", late)
    log.compact()
    monkeypatch.setattr(D, "write_pointer", switch)
    assert {r.run_id: r.status for r in log.current().collect()} == {a: "SUCCESS", b: None}
    log.compact()
    log.failed(b, "x")
    assert {r.run_id: r.status for r in log.current().collect()} == {a: "SUCCESS", b: "FAILED"}
    assert log.current().count() == 2


def test_a_rotation_that_fails_before_its_switch_changes_nothing(spark, tmp_base, monkeypatch):
    schema = "run_id STRING, status STRING, note STRING, seq LONG"
    first = spark.createDataFrame([("a", "RUNNING", "x", 1), ("a", "SUCCESS", None, 2), ("b", "RUNNING", "y", 3)], schema)
    log = D.VersionedLog(spark, tmp_base + "/rot", first.schema)
    assert log.current().count() == log.history().count() == 0
    state = lambda: (sorted(map(tuple, log.history().collect())), sorted(map(tuple, log.current().collect())))
    switch = D.write_pointer

    def broken(path, state):
        raise OSError("lost")

    monkeypatch.setattr(D, "write_pointer", broken)
    with pytest.raises(OSError):
        log.rotate(first)
    assert state() == ([], [])
    monkeypatch.setattr(D, "write_pointer", switch)
    log.rotate(first)
    once = state()
    assert once == ([("a", "SUCCESS", "x", 2)], [("b", "RUNNING", "y", 3)])
    log.rotate()
    assert state() == once
    log.rotate(spark.createDataFrame([("b", "FAILED", None, 9)], schema))
    assert state() == ([("a", "SUCCESS", "x", 2), ("b", "FAILED", "y", 9)], [])


def test_runs_of_a_job_over_midnight_and_gaps(spark):
    import datetime as dt
    t = lambda d, h, m=0: dt.datetime(2024, 1, d, h, m)
    data = [("a", t(1, 23, 30), "RUNNING", None), ("a", t(2, 0, 10), "SUCCESS", None), ("a", t(2, 0, 10), "SUCCESS", None),
            ("a", t(2, 1, 11), "FAILED", 7), ("a", t(2, 1, 12), "FAILED", None), ("a", None, "FAILED", 9), ("a", t(5, 1), "QUEUED", None), ("b", t(1, 1), None, None)]
    df = spark.createDataFrame(data, "step_name STRING, ts TIMESTAMP_NTZ, status STRING, code INT")
    got = rows(D.job_runs(df, "1 HOUR", code="code"), "step_name", "run_no", "n_changes", "n_failed", "exit_code", "duration")
    assert got == [("a", 1, 3, 0, 0, "00:40:00"), ("a", 2, 2, 2, 7, "00:01:00"), ("a", 3, 1, 0, -1, "00:00:00"), ("b", 1, 1, 0, -1, "00:00:00")]


def test_report_of_runs(spark, tmp_base):
    log = D.RunLog(spark, tmp_base + "/log", job_name="j")
    log.success(log.create("a", {}, start=True))
    assert log.report(gap="1 HOUR").count() == log.report().count() == 1


# ------------------------------------- quarantine, ledger, publication ----

def test_malformed_rows_fail_a_step_without_a_quarantine(spark, tmp_base):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.StringType())])
    locs = {n: {"type": "directory", "directory_path": f"{tmp_base}/{n}"} for n in "abq"}
    L.write_partition(spark.createDataFrame([("1", "x"), ("bad7", 'oo"ps\n,'), ("2", "z")], "k STRING, t STRING"), locs, "a", "p", fmt="csv")
    out = I.copy_partition(spark, locs, "a", "b", "p", schema, fmt="csv")
    assert (out["status"], out["n_rejected"], out["error"].exit_code) == ("FAILED", 1, 10)
    with pytest.raises(InvalidSourceError):
        L.read_partition(spark, {"b": dict(locs["b"], split=False)}, "b", "p", schema, fmt="csv")
    out = I.copy_partition(spark, locs, "a", "b", "p", schema, fmt="csv", quarantine="q")
    assert (out["status"], out["n_rows"], out["n_rejected"]) == ("SUCCESS", 2, 1)
    assert rows(L.read_partition(spark, locs, "b", "p", schema, fmt="csv"), "k", "t") == [(1, "x"), (2, "z")]
    text = T.StructType([T.StructField(I.CORRUPT, T.StringType())])
    assert rows(L.read_partition(spark, locs, "q", "p", text), I.CORRUPT) == [('bad7,"oo""ps\n,"',)]


def test_a_landing_that_breaks_off_is_ended_later(spark, tmp_base, monkeypatch):
    schema = T.StructType([T.StructField("x", T.LongType())])
    locs = {"h": {"type": "directory", "directory_path": tmp_base + "/h"}, "z": {"type": "snowflake_landing_zone", "directory_path": tmp_base + "/z"}}
    L.write_partitions(spark.createDataFrame([(i, f"p{i % 3}") for i in range(9)], "x LONG, partition_value STRING"), locs, "h")
    L.write_partition(spark.createDataFrame([], schema), locs, "h", "none")
    L.write_partition(spark.createDataFrame([(77,)], schema), locs, "z", "p1")   # to be replaced
    end, broken = L.publish_pending, []

    def breaks(spark, base):
        if not broken and "_pending" in [s.getPath().getName() for s in _list(spark, base)]:
            broken.append(base)
            fs, path = L._hadoop(spark, base)  # as if one folder had been moved already
            staged = next(s.getPath() for s in _list(spark, base) if s.getPath().getName().startswith("_staging"))
            fs.rename(path(f"{staged.toString()}/partition_value=p0"), path(f"{base}/p0-snowflake"))
            raise OSError("lost")
        return end(spark, base)

    def _list(spark, base):
        fs, path = L._hadoop(spark, base)
        return list(fs.listStatus(path(base))) if fs.exists(path(base)) else []

    monkeypatch.setattr(L, "publish_pending", breaks)
    with pytest.raises(OSError):
        I.land_all(spark, locs, "h", "z", schema)
    monkeypatch.setattr(L, "publish_pending", end)
    assert L.publish_pending(spark, tmp_base + "/z") == 1 and L.publish_pending(spark, tmp_base + "/z") == 0
    want = sorted((i, f"p{i % 3}") for i in range(9))
    assert rows(L.landed_partitions(spark, locs, "z", schema), "x", "partition_value") == want
    assert sorted(r[0] for r in L.present_partitions(spark, locs, "z").collect()) == ["none", "p0", "p1", "p2"]
    assert not [s for s in _list(spark, tmp_base + "/z") if s.getPath().getName().startswith("_")]
    assert I.land_all(spark, locs, "h", "z", schema, ["p2"]) == ["p2"]
    assert rows(L.landed_partitions(spark, locs, "z", schema), "x", "partition_value") == want


def test_a_strict_run_is_resumed_where_it_failed(spark, tmp_base):
    src = FX.days_location(spark, SF_SMALL)
    locs = dict(src, out={"type": "directory", "directory_path": tmp_base + "/out"})
    vals, ledger = ["2024-01-04", "2024-01-05", "2024-01-06"], tmp_base + "/ledger"

    def bad_on_5(df):
        return df.where(F.when(F.col("partition_value") == "2024-01-05", F.raise_error(F.lit("bad day")).cast("boolean")).otherwise(F.lit(True)))

    run = lambda **o: rows(I.ingest_partitions(spark, locs, "days", "out", vals, FX.DAYS_SCHEMA, "fail", ledger=ledger, **o), "partition_value", "status")
    assert run(transform=bad_on_5) == [("2024-01-04", "SUCCESS"), ("2024-01-05", "FAILED")]
    assert run() == [("2024-01-05", "SUCCESS"), ("2024-01-06", "SUCCESS")]
    assert run() == []
    assert rows(I.ledger_rows(spark, ledger), "partition_value", "attempt", "status") == [
        ("2024-01-04", 1, "SUCCESS"), ("2024-01-05", 1, "FAILED"), ("2024-01-05", 2, "SUCCESS"), ("2024-01-06", 1, "SUCCESS")]

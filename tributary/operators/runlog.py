"""The run log as an append-and-fold Spark table (ops D1-D11).

Built-in tables have no UPDATE or MERGE, so every save appends *change rows*
(only the columns that changed are set, or named in ``cleared`` where they are set
to NULL) and the current state of a run is a fold: per run id and column, the last
value that was set, by the change order.
``max_by`` is an ordinary aggregate with a map-side partial step, so a run
id that owns a huge share of the changes never lands whole on one task.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.errors import exit_code_table
from tributary.functions import exprs as X
from tributary.sources.locations import committed_folders, folder_names

# The run statuses, in declaration order.
CLOSED = ("SUCCESS", "FAILED", "SKIPPED", "BLOCKED")
STATUSES = ["QUEUED", "PREPARING", "VALIDATING", "RUNNING", "SUCCESS",
            "FAILED", "BLOCKED", "SKIPPED", "UNKNOWN"]

# The columns of the run log, in order.
LOG_COLUMNS = [
    ("run_id", T.StringType()), ("job_name", T.StringType()), ("step_name", T.StringType()),
    ("status", T.StringType()), ("start_ts", T.TimestampNTZType()), ("end_ts", T.TimestampNTZType()),
    ("partition_value", T.StringType()), ("params", T.StringType()), ("error_message", T.StringType()),
    ("log_path", T.StringType()), ("ttl", T.TimestampNTZType()), ("created_by", T.StringType()),
    ("created_at", T.TimestampNTZType()), ("last_updated_at", T.TimestampNTZType()),
]
LOG_SCHEMA = T.StructType([T.StructField(n, t) for n, t in LOG_COLUMNS])
CLEARED = "cleared"
CHANGE_SCHEMA = T.StructType(list(LOG_SCHEMA.fields) + [T.StructField("seq", T.LongType()), T.StructField(CLEARED, T.ArrayType(T.StringType()))])

DDL = """CREATE TABLE IF NOT EXISTS {name} (
  run_id STRING, job_name STRING, step_name STRING, status STRING,
  start_ts TIMESTAMP_NTZ, end_ts TIMESTAMP_NTZ, partition_value STRING,
  params STRING, error_message STRING, log_path STRING, ttl TIMESTAMP_NTZ,
  created_by STRING DEFAULT 'system',
  created_at TIMESTAMP_NTZ DEFAULT localtimestamp(),
  last_updated_at TIMESTAMP_NTZ
) USING parquet LOCATION '{location}'"""


# ------------------------------------------------------------------ D1 ----

def create_log_table(spark: SparkSession, name: str, location: str) -> str:
    """Create the run-log table if absent, with column defaults."""
    spark.sql(DDL.format(name=name, location=location))
    return name


def insert_run_ids(spark: SparkSession, name: str, ids: DataFrame, col: str = "run_id") -> None:
    """Insert rows that set only ``run_id``; defaults fill the rest."""
    view = f"_ids_{uuid.uuid4().hex[:8]}"
    ids.select(F.col(col).alias("run_id")).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT INTO {name} (run_id) SELECT run_id FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


# --------------------------------------------------------------- D2/D3 ----

def run_counts(log: DataFrame, ids: DataFrame, col: str = "run_id", salt_buckets: int = 0) -> DataFrame:
    """Rows per requested run id, 0 where absent.  The log is
    pre-aggregated before the join, so hot ids cost one row; a hot
    *requested* id can be salted (see ``functions.skew``)."""
    from tributary.functions.skew import salted_join
    per_id = log.groupBy(F.col("run_id").alias("_rid")).agg(F.count(F.lit(1)).alias("n"))
    return (salted_join(ids, per_id, None, [(col, "_rid")], salt_buckets, "left")
            .select(*[ids[c] for c in ids.columns], F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def latest(c: str, order: Column, cleared: bool = False) -> Column:
    """Last value of ``c`` by ``order`` among the rows that set it: those where
    it is not NULL and, with ``cleared``, those whose ``cleared`` names it."""
    is_set = F.col(c).isNotNull()
    if cleared:
        is_set = is_set | F.coalesce(F.array_contains(CLEARED, F.lit(c)), F.lit(False))
    return F.max_by(F.col(c), F.when(is_set, order)).alias(c)


def fold_changes(changes: DataFrame, key: str = "run_id", order: Column | None = None,
                 columns: list[str] | None = None) -> DataFrame:
    """D3: current state per key -- sparse last-write-wins per column.

    ``order`` defaults to ``seq``; any orderable column or struct works (e.g.
    ``struct(ts, event_id)``).  A column that is NULL in a change is not set by
    it, unless the change's ``cleared`` (an array of column names; the column may
    be absent) names it: then it is set to NULL."""
    order = F.col("seq") if order is None else order
    cols = columns or [c for c in changes.columns if c not in (key, "seq", CLEARED)]
    return changes.groupBy(key).agg(*[latest(c, order, CLEARED in changes.columns) for c in cols])


def upsert(current: DataFrame, changes: DataFrame, key: str = "run_id",
           order: Column | None = None) -> DataFrame:
    """D3 as one step: the current rows first, then the new changes, folded.
    With several changes of a key, ``order`` (a long, unique within a key) says
    which is last.  A change may carry ``cleared`` as in ``fold_changes``."""
    cols = [c for c in current.columns if c != key]
    none = F.lit(None).cast("array<string>").alias(CLEARED)
    base = current.select(key, *cols, F.lit(None).cast("long").alias("seq"), none)
    new = changes.select(key, *[F.col(c) if c in changes.columns else F.lit(None).cast(current.schema[c].dataType).alias(c)
                                for c in cols], (F.lit(1) if order is None else order).cast("long").alias("seq"),
                         F.col(CLEARED) if CLEARED in changes.columns else none)
    return fold_changes(base.unionByName(new), key, F.struct(F.col("seq").isNotNull(), "seq"), cols)


# ------------------------------------------------------------------ D4 ----

def current_runs(changes: DataFrame, order: Column, key: str = "run_id") -> DataFrame:
    """Current state of each run plus its change count and first/last
    change stamps."""
    cols = [c for c in ("job_name", "step_name", "status", "start_ts", "end_ts", "partition_value",
                        "params", "error_message", "ttl", "last_updated_at") if c in changes.columns]
    return changes.groupBy(key).agg(*[latest(c, order) for c in cols],
                                    F.count(F.lit(1)).alias("n_changes"))


# ------------------------------------------------------------ D5 - D11 ----

def normalize_status(c="status") -> Column:
    """Statuses outside the domain read as UNKNOWN."""
    s = X.col(c)
    return F.when(s.isin(*STATUSES), s).otherwise(F.lit("UNKNOWN"))


def status_counts(runs: DataFrame, c: str = "status") -> DataFrame:
    return runs.groupBy(normalize_status(c).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def ttl_from(ts, years: int = 1) -> Column:
    """Time-to-live stamp, ``ts`` + ``years`` calendar years."""
    return X.add_years(ts, years)


def live_rows(log: DataFrame, as_of: str, ttl_col: str = "ttl") -> DataFrame:
    """Rows whose TTL is still ahead of ``as_of``."""
    return log.where(F.col(ttl_col) > F.lit(as_of).cast("timestamp_ntz"))


def duration_text(start, end) -> Column:
    """``HH:MM:SS`` of whole seconds between two stamps."""
    return X.hms(X.duration_seconds(start, end))


def job_summary(runs: DataFrame, group: str = "step_name", start: str = "start",
                end: str = "end", status: str = "status", code: str | None = None) -> DataFrame:
    """Per job (or step): first start, last end, run counts, exit code
    (of the failed runs the largest ``code`` -- D10's, 1 without such a column;
    -1 while any run is unfinished, else 0) and the duration; stamps as ``yyyy-MM-dd HH:mm:ss`` text."""
    s = F.col(status)
    agg = runs.groupBy(group).agg(
        F.min(start).alias("_start"), F.max(end).alias("_end"),
        F.count(F.lit(1)).alias("n_runs"),
        F.sum(F.when(s == "FAILED", 1).otherwise(0)).cast("long").alias("n_failed"),
        F.sum(F.when(s.isin(*CLOSED), 0).otherwise(1)).cast("long").alias("n_open"),
        F.max(F.when(s == "FAILED", F.lit(1) if code is None else F.coalesce(F.col(code), F.lit(1)))).alias("_code"),
    )
    return agg.select(
        group, X.ts_text("_start").alias("start_ts"), X.ts_text("_end").alias("end_ts"),
        "n_runs", "n_failed",
        F.when(F.col("n_failed") > 0, F.col("_code")).when(F.col("n_open") > 0, -1).otherwise(0).alias("exit_code"),
        duration_text("_start", "_end").alias("duration"),
    )


def job_runs(changes: DataFrame, gap: str, job: str = "step_name", ts: str = "ts", order: Column | None = None,
             status: str = "status", code: str | None = None) -> DataFrame:
    """D9, a row per run of a job: changes of a job that follow each other within
    ``gap`` (an interval as text) belong to one run.

    ``run_no`` (from 1, by time), first and last stamp, changes, failed changes, exit code
    (of the failed ones the largest ``code`` -- D10's, 1 where there is none; else
    -1 if the last change, by ``order``, leaves the run open, else 0), duration.  Changes
    without a stamp belong to no run.

    A job may hold most of all changes: each of its days is cut into sessions for itself,
    and only the sessions' ends meet, in order, to be joined over midnight."""
    s, order = F.col(status), F.struct(F.col(ts)) if order is None else order
    step = F.expr(f"INTERVAL {gap}")
    day = changes.where(F.col(ts).isNotNull()).withColumn("_day", F.to_date(ts))
    in_day = Window.partitionBy(job, "_day").orderBy(F.col(ts))
    starts = F.lag(ts).over(in_day)
    day = day.withColumn("_new", F.when(starts.isNull() | (F.col(ts) > starts + step), 1).otherwise(0))
    day = day.withColumn("_part", F.sum("_new").over(in_day.rowsBetween(Window.unboundedPreceding, 0)))
    parts = day.groupBy(job, "_day", "_part").agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("n_changes"),
        F.sum(F.when(s == "FAILED", 1).otherwise(0)).alias("n_failed"),
        F.max(F.when(s == "FAILED", F.lit(1) if code is None else F.coalesce(F.col(code), F.lit(1)))).alias("_code"),
        F.max_by(s, F.when(s.isNotNull(), order)).alias("_end"))
    of_job = Window.partitionBy(job).orderBy("_first")
    before = F.lag("_last").over(of_job)
    parts = parts.withColumn("_new", F.when(before.isNull() | (F.col("_first") > before + step), 1).otherwise(0))
    parts = parts.withColumn("run_no", F.sum("_new").over(of_job.rowsBetween(Window.unboundedPreceding, 0)))
    runs = parts.groupBy(job, "run_no").agg(
        F.min("_first").alias("_start"), F.max("_last").alias("_stop"), F.sum("n_changes").alias("n_changes"), F.sum("n_failed").alias("n_failed"),
        F.max("_code").alias("_code"), F.max_by("_end", F.when(F.col("_end").isNotNull(), F.col("_first"))).alias("_end"))
    open_ = ~F.coalesce(F.col("_end").isin(*CLOSED), F.lit(False))
    return runs.select(
        job, "run_no", X.ts_text("_start").alias("start_ts"), X.ts_text("_stop").alias("end_ts"), "n_changes", "n_failed",
        F.when(F.col("n_failed") > 0, F.col("_code")).when(open_, -1).otherwise(0).cast("int").alias("exit_code"),
        duration_text("_start", "_stop").alias("duration"))


def exit_codes(df: DataFrame, error_name: str, out: str = "exit_code") -> DataFrame:
    """Exit code per row from its error name via the 22-row code table
    (broadcast: its size is fixed); unknown errors -> 1, no error -> 0."""
    codes = F.broadcast(exit_code_table(df.sparkSession)
                        .select(F.col("name").alias("_ename"), F.col("code").alias("_code")))
    j = df.join(codes, df[error_name] == codes["_ename"], "left")
    return j.select(*[df[c] for c in df.columns],
                    F.when(F.col(error_name).isNull(), 0)
                     .otherwise(F.coalesce("_code", F.lit(1))).cast("int").alias(out))


def error_payloads(df: DataFrame, message: str, out: str = "error_message") -> DataFrame:
    """Failure payload JSON in ``error_message``."""
    return df.withColumn(out, X.error_payload(message))


# ------------------------------------------------------- writer (driver) ----

class RunLog:
    """A run log kept as change rows under a shared folder.

    Each call appends a handful of rows (the driver is the only writer, as
    in the reference); ``current()`` folds them.  ``compact()`` writes the
    folded state as a new version and switches to it -- it never rewrites a
    folder that is being read."""

    def __init__(self, spark: SparkSession, path: str, job_name: str | None = None,
                 ttl_years: int = 1, created_by: str = "system"):
        self.spark, self.path, self.job_name = spark, path.rstrip("/"), job_name
        self.ttl_years, self.created_by = ttl_years, created_by
        self._seq = 0
        self._lock = threading.Lock()  # jobs of one run may log from several threads

    # Changes are always appended to folders under ``changes``.  A small
    # pointer file names the folded state and the change folders it holds; all
    # others are live, also those appended while a compaction ran.
    def _pointer(self):
        return pointer_of(self.path)

    def _state(self) -> dict:
        state = read_pointer(*self._pointer())
        if state is None:
            return {"base": None, "folded": []}
        if isinstance(state, str):  # a pointer of an earlier layout: the folder that took all later changes, too
            return {"base": state, "folded": committed_folders(self.spark, f"{self.path}/changes")}
        return state

    def compact(self, as_of: str | None = None) -> str:
        """Fold what is logged now into one row per run, written as a new
        version, and switch to it.  With ``as_of``, runs whose TTL has passed are
        purged.  Exactly the change folders listed at the start are folded: a
        change appended meanwhile stays live.  Returns the new folder.  One
        compaction may run at a time; one that ends before the switch
        changes nothing."""
        state, names = self._state(), committed_folders(self.spark, f"{self.path}/changes")
        folded = fold_changes(self._read(state, names), "run_id", F.col("seq"), [n for n, _ in LOG_COLUMNS if n != "run_id"])
        if as_of is not None:
            folded = folded.where(F.col("ttl").isNull() | (F.col("ttl") > F.lit(as_of).cast("timestamp_ntz")))
        # seq 0: whatever is appended is later than what was folded
        folded = folded.withColumn("seq", F.lit(0).cast("long")).withColumn(CLEARED, F.lit(None).cast("array<string>"))
        name = f"folded-{uuid.uuid4().hex[:12]}"
        folded.select(*CHANGE_SCHEMA.fieldNames()).write.parquet(f"{self.path}/{name}")
        write_pointer(self.path, {"base": name, "folded": names})
        return f"{self.path}/{name}"

    def _read(self, state: dict, names: list[str]) -> DataFrame:
        paths = [f"{self.path}/changes/{n}" for n in names if n not in set(state["folded"])]
        paths += [f"{self.path}/{state['base']}"] if state["base"] else []
        if not paths:
            return self.spark.createDataFrame([], CHANGE_SCHEMA)
        return self.spark.read.schema(CHANGE_SCHEMA).option("recursiveFileLookup", "true").parquet(*paths)

    def _row(self, run_id: str, cols: dict) -> dict:
        with self._lock:
            self._seq = max(self._seq + 1, int(dt.datetime.now().timestamp() * 1e6))
            seq = self._seq
        row = {n: None for n in CHANGE_SCHEMA.fieldNames()}
        row.update(cols)
        row["run_id"] = run_id
        row["seq"] = seq
        return row

    def _append(self, rows: list[dict]) -> None:
        """Each append is its own folder: concurrent writers (threads of one
        run, or several drivers) never share a commit area."""
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        folder = f"{self.path}/changes/{rows[0]['seq']:020d}-{uuid.uuid4().hex[:8]}"
        table = pa.Table.from_pylist(rows, to_arrow_schema(CHANGE_SCHEMA))
        self.spark.createDataFrame(table, CHANGE_SCHEMA).coalesce(1).write.mode("error").parquet(folder)

    def save(self, run_id: str, *more: dict, **cols) -> None:
        """Append one change (plus optional further changes) in one write;
        ``cleared=[names]`` sets columns to NULL."""
        self._append([self._row(run_id, cols)] + [self._row(run_id, m) for m in more])

    def create(self, step: str, params: dict, partition_value: str | None = None,
               run_suffix: str | None = None, start: bool = False) -> str:
        """New run row; ``start=True`` also records RUNNING in the same write."""
        run_id = f"{step}{X.RUN_ID_SEPARATOR}{run_suffix or uuid.uuid4()}"
        now = dt.datetime.now()
        ttl = _add_years(now, self.ttl_years)
        more = [{"status": "RUNNING", "last_updated_at": now}] if start else []
        self.save(run_id, *more, job_name=self.job_name or step, step_name=step, start_ts=now,
                  partition_value=partition_value, params=json.dumps(params, default=str, sort_keys=True),
                  ttl=ttl, created_by=self.created_by, created_at=now, last_updated_at=now)
        return run_id

    def create_many(self, steps: list[tuple[str, dict]], partition_value: str | None = None,
                    status: str | None = "QUEUED") -> dict[str, str]:
        """One new run per step, all in one write (e.g. QUEUED at job start)."""
        now = dt.datetime.now()
        ids, rows = {}, []
        for step, params in steps:
            run_id = f"{step}{X.RUN_ID_SEPARATOR}{uuid.uuid4()}"
            ids[step] = run_id
            rows.append(self._row(run_id, dict(
                job_name=self.job_name or step, step_name=step, status=status, start_ts=now,
                partition_value=partition_value, params=json.dumps(params, default=str, sort_keys=True),
                ttl=_add_years(now, self.ttl_years), created_by=self.created_by, created_at=now,
                last_updated_at=now)))
        self._append(rows)
        return ids

    def start(self, run_id: str) -> None:
        now = dt.datetime.now()  # a queued run starts now, not when it was queued
        self.save(run_id, status="RUNNING", start_ts=now, last_updated_at=now)

    def success(self, run_id: str, log_path: str | None = None) -> None:
        now = dt.datetime.now()
        self.save(run_id, status="SUCCESS", end_ts=now, last_updated_at=now, log_path=log_path)

    def closed(self, run_id: str, status: str, reason: str) -> None:
        """A run that ends without having run (SKIPPED, BLOCKED)."""
        now = dt.datetime.now()
        self.save(run_id, status=status, error_message=reason, end_ts=now, last_updated_at=now)

    def failed(self, run_id: str, error_message: str = "Error") -> None:
        now = dt.datetime.now()
        self.save(run_id, status="FAILED", error_message=error_message, end_ts=now, last_updated_at=now)

    def report(self, group: str = "job_name", gap: str | None = None) -> DataFrame:
        """The job report (D9) from the log.  With ``gap`` (an interval as text) a row
        per run of a job, its changes following each other within that
        (``job_runs``); else per job over all its runs: first start, last end, run
        counts, exit code and duration."""
        if gap is None:
            return job_summary(self.current(), group, start="start_ts", end="end_ts")
        jobs = self.current().select("run_id", F.col(group).alias("_job"))
        changes = self.changes().drop(group).join(jobs, "run_id").withColumnRenamed("_job", group)
        return job_runs(changes, gap, group, "last_updated_at", F.col("seq"))

    def changes(self) -> DataFrame:
        return self._read(self._state(), committed_folders(self.spark, f"{self.path}/changes"))

    def current(self) -> DataFrame:
        return fold_changes(self.changes(), "run_id", F.col("seq"),
                            [n for n, _ in LOG_COLUMNS if n != "run_id"])


def _add_years(ts: dt.datetime, years: int) -> dt.datetime:
    try:
        return ts.replace(year=ts.year + years)
    except ValueError:  # 29 Feb -> 28 Feb
        return ts.replace(year=ts.year + years, day=28)


# ------------------------------------------------------------------ S6 ----

def pointer_of(path: str):
    """(file system, file) of the pointer of a log folder."""
    from tributary.session import filesystem
    fs, base = filesystem(path)
    return fs, f"{base}/CURRENT"


def read_pointer(fs, file: str) -> dict | str | None:
    """What a pointer says (None: there is none yet; any other error is raised)."""
    try:
        with fs.open_input_stream(file) as fh:
            text = fh.read().decode("utf-8").strip()
    except FileNotFoundError:
        return None
    return json.loads(text) if text.startswith("{") else text


def write_pointer(path: str, state: dict) -> None:
    """The switch: a version counts from here on."""
    fs, file = pointer_of(path)
    fs.create_dir(file.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(file) as fh:
        fh.write(json.dumps(state).encode("utf-8"))


class VersionedLog:
    """Change rows of open runs and one row per closed run, in versions.

    ``path`` holds a folder per version and the pointer, which names the version
    that is current and the versions whose closed rows make up the history.
    A rotation is one write, split by open and closed, and then one switch of
    the pointer: readers see the state before or after it, and a rotation that
    failed in between leaves a folder that nothing names, so running it again
    never doubles the history."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _state(self) -> dict:
        return read_pointer(*pointer_of(self.path)) or {"current": None, "history": []}

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def _present(self, part: str, versions: list[str]) -> list[str]:
        return [f"{v}/part={part}" for v in versions if f"part={part}" in folder_names(self.spark, f"{self.path}/{v}")]

    def current(self) -> DataFrame:
        """The change rows of open runs."""
        version = self._state()["current"]
        return self._read(self._present("open", [version] if version else []))

    def history(self) -> DataFrame:
        """One folded row per closed run."""
        return self._read(self._present("closed", self._state()["history"]))

    def rotate(self, new: DataFrame | None = None, order: Column | None = None, closed=CLOSED) -> None:
        """Move the runs whose folded status is in ``closed`` from the current log,
        with the change rows ``new`` added, to the history.  Without
        ``new`` or closed runs nothing changes."""
        order = F.col("seq") if order is None else order
        state = self._state()
        changes = self.current() if new is None else self.current().unionByName(new.select(*self.schema.fieldNames()))
        masked = CLEARED in changes.columns
        done = changes.groupBy("run_id").agg(latest("status", order, masked)).where(F.col("status").isin(*closed)).select("run_id")
        ended = fold_changes(changes.join(done, "run_id", "left_semi"), "run_id", order, [c for c in changes.columns if c not in ("run_id", CLEARED)])
        if masked:
            ended = ended.withColumn(CLEARED, F.lit(None).cast("array<string>"))
        open_ = changes.join(done, "run_id", "left_anti")
        version = f"v{len(state['history']) + 1}-{uuid.uuid4().hex[:8]}"
        open_.withColumn("part", F.lit("open")).unionByName(ended.withColumn("part", F.lit("closed"))).write.partitionBy("part").parquet(f"{self.path}/{version}")
        write_pointer(self.path, {"current": version, "history": [*state["history"], version]})

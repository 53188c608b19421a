"""Ingestion runs (ops A9, F4, F5).

``copy_partition`` is one step: read a source partition, transform, write
the sink partition, and record RUNNING -> SUCCESS/FAILED in the run log.
Spark is lazy, so errors surface at the write; the write is what is
guarded.  ``ingest_partitions`` applies a failure policy over many
partition values: ``fail`` stops at the first error, ``continue`` records
it and goes on -- except a missing source (InvalidSourceError), which
always stops.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.errors import InvalidSourceError, MalformedRowsError, exit_code_of
from tributary.operators.runlog import RunLog
from tributary.sources import locations as L

CORRUPT = "_corrupt_record"

OUTCOME_SCHEMA = T.StructType([
    T.StructField("seq", T.IntegerType()),
    T.StructField("partition_value", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("exit_code", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("target_path", T.StringType()),
])


def observed_write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                   metrics: dict | None = None, partition_by: list[str] | None = None,
                   options: dict | None = None) -> dict:
    """write ``df`` and report metrics gathered during the same job
    (``df.observe``) plus the wall time of the write measured on the driver."""
    metrics = metrics or {"n_rows": F.count(F.lit(1))}
    obs = Observation("write")
    observed = df.observe(obs, *[c.alias(k) for k, c in metrics.items()])
    t0 = time.perf_counter()
    w = observed.write.format(fmt).mode(mode)
    if fmt == "csv":  # as the readers expect it
        w = w.options(**{**L.CSV_OPTIONS, **(options or {})})
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    out = dict(obs.get)
    out["seconds"] = time.perf_counter() - t0
    out["path"] = path
    return out


def copy_partition(spark: SparkSession, locations: dict, source: str, target: str, pv: str,
                   schema: T.StructType, fmt: str = "parquet", target_fmt: str | None = None,
                   transform: Callable[[DataFrame], DataFrame] | None = None,
                   run_log: RunLog | None = None, step: str = "transport",
                   params: dict | None = None, run_suffix: str | None = None,
                   run_id: str | None = None, skip_empty: bool = False,
                   quarantine: str | None = None, content: bool = False) -> dict:
    """Source partition -> optional transform -> sink partition.

    Returns ``{status, n_rows, n_rejected, target_path, error, run_id}``; raises
    nothing except through the caller's policy (the error object is in ``error``).

    CSV rows that do not fit the schema are counted by the job that writes the
    others to a staging folder beside the target: with ``quarantine`` (a location)
    their text goes to its partition of the same value (the source is parsed
    again if there are any), without it any such row fails the step and the target
    stays as it was.  ``content`` adds ``content_hash``,
    of what was written, in any order."""
    if run_log is not None and run_id is not None:
        run_log.start(run_id)
    elif run_log is not None:
        run_id = run_log.create(step, dict(params or {}, source=source, target=target,
                                           partition_value=pv), partition_value=pv,
                                run_suffix=run_suffix, start=True)
    n_rejected, staged = 0, None
    try:
        path = L.partition_path(locations, target, pv)
        if fmt == "csv":
            parsed = L.read_csv_partition(spark, locations, source, pv, schema, CORRUPT)
            bad, seen = F.col(CORRUPT).isNotNull(), Observation(f"bad-{uuid.uuid4().hex[:8]}")
            df = parsed.observe(seen, F.sum(F.when(bad, 1).otherwise(0)).alias("n")).where(~bad).drop(CORRUPT)
            staged = f"{path.rsplit('/', 1)[0]}/_staging-{uuid.uuid4().hex[:12]}"
        else:
            parsed = df = L.read_partition(spark, locations, source, pv, schema, fmt)
        if skip_empty and parsed.isEmpty():  # reads at most one row
            if run_log is not None:
                run_log.closed(run_id, "SKIPPED", "empty source partition")
            return {"status": "SKIPPED", "n_rows": 0, "n_rejected": 0, "target_path": None, "error": None,
                    "run_id": run_id, "content_hash": None}
        if transform is not None:
            df = df.transform(transform)
        df = df.drop(L.PV)
        metrics = {"n_rows": F.count(F.lit(1))}
        if content:
            metrics["content"] = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
        stats = observed_write(df, staged or path, fmt=target_fmt or fmt, metrics=metrics,
                               options=L.csv_options(L.get_config(locations, target)))
        if staged is not None:
            n_rejected = int(seen.get.get("n") or 0)
            if n_rejected and quarantine is None:
                raise MalformedRowsError(f"{n_rejected} rows do not fit the schema")
            L.replace_folder(spark, staged, path)
            staged = None
        if quarantine is not None:  # also when it is empty: an earlier attempt's rows go
            rejected = parsed.where(bad).select(CORRUPT) if n_rejected else spark.createDataFrame([], f"{CORRUPT} STRING")
            L.write_partition(rejected, locations, quarantine, pv)
        if run_log is not None:
            run_log.success(run_id, log_path=path)   # where this run's output went
        return {"status": "SUCCESS", "n_rows": int(stats["n_rows"]), "n_rejected": n_rejected, "target_path": path,
                "error": None, "run_id": run_id, "content_hash": str(stats["content"] or 0) if content else None}
    except Exception as e:  # recorded, then handed to the policy
        if staged is not None:
            L.delete_folder(spark, staged)
        if run_log is not None:
            run_log.failed(run_id, str(e))
        return {"status": "FAILED", "n_rows": None, "n_rejected": n_rejected, "target_path": None, "error": e,
                "run_id": run_id, "content_hash": None}


def ingest_partitions(spark: SparkSession, locations: dict, source: str, target: str,
                      values: list[str], schema: T.StructType, policy: str = "fail",
                      fmt: str = "parquet", transform=None, run_log: RunLog | None = None,
                      step: str = "transport", concurrent_jobs: int = 1, ledger: str | None = None) -> DataFrame:
    """one outcome row per partition value attempted, in order.

    Missing partitions are found first in one job (A3 set form), so the run
    knows where a missing source will stop it before copying anything.
    Every partition is a write of its own, whatever the locations' types and
    layouts: it replaces the target's folder, also by nothing if the source
    is empty.  Under ``continue`` the copies are independent and may run as
    ``concurrent_jobs`` concurrent Spark jobs; under ``fail`` they run one
    after another and stop at the first error.

    With ``ledger`` (a folder) every attempt is noted when it ends: partition,
    attempt, outcome, rows, hash of the content.  Values whose last attempt succeeded
    are not attempted again, so a run that failed, stopped or was lost is
    resumed by running it again; ``ledger_rows`` reads the notes."""
    if policy not in ("fail", "continue"):
        raise ValueError("policy must be 'fail' or 'continue'")
    req = L.requested_values(spark, values)
    missing = {r[0] for r in L.missing_partitions(spark, locations, source, req, fmt).collect()}
    attempts, done = _attempts(spark, ledger)
    values = [pv for pv in values if pv not in done]
    stop_at = next((i for i, pv in enumerate(values) if pv in missing), len(values))

    def note(pv, status, n_rows, err, content_hash=None):
        if ledger is not None:
            _note(ledger, {"partition_value": pv, "attempt": attempts.get(pv, 0) + 1, "status": status, "n_rows": n_rows,
                           "exit_code": exit_code_of(err), "content_hash": content_hash})

    def attempt(item):
        i, pv = item
        out = copy_partition(spark, locations, source, target, pv, schema, fmt,
                             transform=transform, run_log=run_log, step=step, content=ledger is not None)
        err = out["error"]
        note(pv, out["status"], out["n_rows"], err, out["content_hash"])
        return err, (i, pv, out["status"], out["n_rows"], exit_code_of(err),
                     None if err is None else f"{type(err).__name__}: {err}", out["target_path"])

    rows = []
    todo = list(enumerate(values[:stop_at]))
    if policy == "continue" and concurrent_jobs > 1:
        with ThreadPoolExecutor(max_workers=concurrent_jobs) as pool:
            rows = [row for _, row in pool.map(attempt, todo)]
    else:
        for item in todo:
            err, row = attempt(item)
            rows.append(row)
            if err is not None and (policy == "fail" or isinstance(err, InvalidSourceError)):
                break  # a source that vanished after the check also stops the run
    stopped_early = len(rows) < stop_at
    if stop_at < len(values) and not stopped_early:
        pv = values[stop_at]
        err = InvalidSourceError(f"no folder at {L.partition_path(locations, source, pv)}")
        if run_log is not None:
            rid = run_log.create(step, {"source": source, "target": target}, partition_value=pv)
            run_log.failed(rid, str(err))
        note(pv, "FAILED", None, err)
        rows.append((stop_at, pv, "FAILED", None, exit_code_of(err), str(err), None))
    return spark.createDataFrame(rows, OUTCOME_SCHEMA)


LEDGER_SCHEMA = "partition_value STRING, attempt INT, status STRING, n_rows LONG, exit_code INT, content_hash STRING"


def _note(ledger: str, row: dict) -> None:
    """One small file per attempt: writers never share one, and it is there whole or not at all."""
    from tributary.session import filesystem
    fs, root = filesystem(ledger)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{uuid.uuid4().hex}.json") as fh:
        fh.write(json.dumps(row).encode("utf-8"))


def ledger_rows(spark: SparkSession, ledger: str) -> DataFrame:
    """Every attempt noted in a ledger (none yet: no rows)."""
    from tributary.session import filesystem
    fs, root = filesystem(ledger)
    fs.create_dir(root, recursive=True)
    return spark.read.schema(LEDGER_SCHEMA).json(ledger)


def _attempts(spark: SparkSession, ledger: str | None) -> tuple[dict[str, int], set[str]]:
    """(attempts so far, values whose last attempt succeeded): a row per
    partition value, as the caller's list of values is."""
    if ledger is None:
        return {}, set()
    last = ledger_rows(spark, ledger).groupBy("partition_value").agg(
        F.max("attempt").alias("n"), F.max_by("status", "attempt").alias("status")).collect()
    return {r.partition_value: r.n for r in last}, {r.partition_value for r in last if r.status == "SUCCESS"}


def land_all(spark: SparkSession, locations: dict, source: str, target: str,
             schema: T.StructType, values: list[str] | None = None, fmt: str = "parquet") -> list[str]:
    """Land every (or the given) partition of a location in a landing zone (A5).

    One job writes all partitions to a staging folder beside the targets (a hot
    value over several tasks); then each staged folder replaces its target by a
    rename, on any store.  What is to be renamed is written down first: a
    landing that breaks off is ended by ``locations.publish_pending``, or by the
    next one."""
    present = sorted(r[0] for r in L.present_partitions(spark, locations, source, fmt).collect())
    gone = set(values or []) - set(present)
    if gone:
        raise InvalidSourceError(f"no folder for {sorted(gone)[0]}")
    values = present if values is None else list(values)
    base = L.get_config(locations, target)["directory_path"].rstrip("/")
    L.publish_pending(spark, base)
    rows = L.read_partitions(spark, locations, source, schema, fmt)
    if len(values) < len(present):
        rows = rows.join(L.requested_values(spark, values), L.PV, "left_semi")
    staged = f"{base}/_staging-{uuid.uuid4().hex[:12]}"
    rows.hint("rebalance", L.PV).write.format(fmt).partitionBy(L.PV).save(staged)
    names = {L.decode(n.removeprefix(f"{L.PV}=")): n for n in L.folder_names(spark, staged)}
    L.publish(spark, base, staged, [(names.get(pv), L.partition_path(locations, target, pv).removeprefix(f"{base}/")) for pv in values])
    return values

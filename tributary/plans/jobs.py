"""Config-driven job runs: locations + steps, one partition value per run.

A job config mirrors the reference's YAML as a dict::

    {"name": "test job",
     "locations": {"source_folder": {"type": "directory", "directory_path": ...}, ...},
     "steps": {"transport": {"uses": "copy",
                             "params": {"source": "source_folder", "target": "working_folder"}},
               "process": {"depends_on": "transport", "uses": "copy",
                           "params": {"source": "working_folder", "target": "source_folder",
                                      "source_file_format": "csv"}}}}

Steps are ordered by the step-graph peel (E3); a cycle stops the job before
anything runs.  Every step gets a QUEUED row at the start; each step is one
``copy_partition`` (read -> named transform -> write) logged RUNNING ->
SUCCESS/FAILED; steps downstream of a failure are BLOCKED, and with the
``fail`` policy steps not reached are SKIPPED.  Steps of the same level may
run as concurrent Spark jobs.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.errors import (ActionNotFound, CycleError, InvalidConfigError,
                              InvalidSourceError, exit_code_of)
from tributary.functions import registry as R
from tributary.operators import deps as E
from tributary.operators.runlog import RunLog
from tributary.plans.ingest import copy_partition

STEP_OUTCOME = T.StructType([
    T.StructField("step", T.StringType()),
    T.StructField("level", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("exit_code", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("partition_value", T.StringType()),
])


@R.register("copy")
def _copy(df: DataFrame) -> DataFrame:
    """Move data unchanged (the sample config's placeholder action)."""
    return df


def steps_frame(spark: SparkSession, config: dict) -> DataFrame:
    rows = []
    for name, ctx in (config.get("steps") or {}).items():
        dep = ctx.get("depends_on")
        deps = [dep] if isinstance(dep, str) else list(dep or [])
        rows.append((name, ctx.get("uses"), deps))
    return spark.createDataFrame(rows, "name STRING, uses STRING, depends_on ARRAY<STRING>")


def step_order(spark: SparkSession, config: dict) -> list[tuple[int, str]]:
    """(level, step) for every step; raises CycleError on a cycle.  The
    step table is configuration-sized, so the order comes to the driver."""
    steps = steps_frame(spark, config)
    edges = E.accepted_edges(E.step_edges(steps))
    levels, remaining = E.peel(edges, E.step_nodes(steps, edges))
    stuck = [r[0] for r in remaining.collect()]
    if stuck:
        raise CycleError(f"Graph contains a cycle: {sorted(stuck)}")
    return sorted((int(r.level), r.node) for r in levels.collect())


def run_job(spark: SparkSession, config: dict, partition_value: str, schema=None,
            policy: str = "fail", run_log: RunLog | None = None,
            concurrent_jobs: int = 4) -> DataFrame:
    """Run every step for one partition value; one outcome row per step.
    Steps of one level (independent of each other) run as up to
    ``concurrent_jobs`` concurrent Spark jobs.

    ``schema`` is one StructType for all sources or a dict step -> StructType;
    a step's ``params.schema`` (DDL text) takes precedence.  A step with
    ``params.skip_empty`` is SKIPPED (not failed) when its source partition
    has no rows."""
    order = step_order(spark, config)
    steps = config["steps"]
    parents = {n: ([c["depends_on"]] if isinstance(c.get("depends_on"), str)
                   else list(c.get("depends_on") or [])) for n, c in steps.items()}
    log = run_log or RunLog(spark, config["log_path"], job_name=config.get("name")) \
        if (run_log or config.get("log_path")) else None
    queued = {}
    if log is not None:
        queued = log.create_many([(n, steps[n].get("params") or {}) for _, n in order], partition_value)
    outcome: dict[str, tuple] = {}
    stop = False

    def run_step(level: int, name: str) -> tuple:
        ctx = steps[name]
        params = dict(ctx.get("params") or {})
        try:
            transform = R.get(ctx.get("uses") or "copy")
            if not params.get("source") or not params.get("target"):
                raise InvalidConfigError(f"step '{name}' needs params.source and params.target")
        except (ActionNotFound, InvalidConfigError) as e:
            if log is not None and name in queued:
                log.failed(queued[name], str(e))
            return (name, level, "FAILED", None, exit_code_of(e), str(e), partition_value), e
        src_fmt = params.get("source_file_format", "parquet")
        tgt_fmt = params.get("target_file_format", "parquet")
        if params.get("schema"):  # DDL text in the step config
            sch = spark.createDataFrame([], params["schema"]).schema
        else:
            sch = schema[name] if isinstance(schema, dict) else schema
        extra = params.get("transform_params") or {}
        out = copy_partition(spark, config["locations"], params["source"], params["target"],
                             partition_value, sch, fmt=src_fmt, target_fmt=tgt_fmt,
                             transform=(lambda df: transform(df, **extra)), run_log=log, step=name,
                             params=params, run_id=queued.get(name),
                             skip_empty=bool(params.get("skip_empty", False)))
        err = out["error"]
        return ((name, level, out["status"], out["n_rows"], exit_code_of(err),
                 None if err is None else f"{type(err).__name__}: {err}", partition_value), err)

    for level in sorted({lv for lv, _ in order}):
        names = [n for lv, n in order if lv == level]
        runnable = []
        for n in names:
            if stop:
                outcome[n] = (n, level, "SKIPPED", None, None, None, partition_value)
            elif any(outcome.get(p, (None,) * 3)[2] in ("FAILED", "BLOCKED", "SKIPPED") for p in parents[n]):
                outcome[n] = (n, level, "BLOCKED", None, None, "an upstream step did not succeed",
                              partition_value)
            else:
                runnable.append(n)
        for n in names:
            if n in outcome and log is not None and n in queued:
                log.closed(queued[n], outcome[n][2], "not run")
        with ThreadPoolExecutor(max_workers=max(1, concurrent_jobs)) as pool:
            results = list(pool.map(lambda n: run_step(level, n), runnable))
        for row, err in results:
            outcome[row[0]] = row
            if err is not None and (policy == "fail" or isinstance(err, InvalidSourceError)):
                stop = True
    return spark.createDataFrame([outcome[n] for _, n in order], STEP_OUTCOME)


def job_exit_code(outcomes: DataFrame) -> DataFrame:
    """Exit code of the whole run: the highest code among failed steps, else 0."""
    return outcomes.agg(F.coalesce(F.max(F.when(F.col("status") == "FAILED", F.col("exit_code"))),
                                   F.lit(0)).alias("exit_code"))

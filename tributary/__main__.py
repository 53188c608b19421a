"""Run a job config for one partition value.

    python -m tributary job.yaml 2023-04-31 [--policy continue] [--master local[8]]

The config is YAML (if a YAML reader is installed) or JSON, shaped as in
``tributary.plans.jobs``.  Prints one outcome row per step and exits with
the job's exit code.  ``--master`` is only for local runs; on a cluster the
session comes from ``spark-submit``.
"""

from __future__ import annotations

import argparse
import json
import sys


def load_config(path: str) -> dict:
    with open(path, encoding="utf-8") as fh:
        text = fh.read()
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:  # pragma: no cover
            raise SystemExit("YAML configs need PyYAML; use JSON instead") from e
        return yaml.safe_load(text)
    return json.loads(text)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tributary")
    ap.add_argument("config")
    ap.add_argument("partition_value")
    ap.add_argument("--policy", choices=["fail", "continue"], default="fail")
    ap.add_argument("--master", default=None)
    ap.add_argument("--concurrent-jobs", type=int, default=4)
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from tributary.errors import TributaryError
    from tributary.plans.jobs import job_exit_code, run_job
    from tributary.session import build_session, ensure_checkpoint_dir

    spark = build_session(master=a.master) if a.master else SparkSession.builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    try:
        out = run_job(spark, load_config(a.config), a.partition_value, policy=a.policy,
                      concurrent_jobs=a.concurrent_jobs)
    except TributaryError as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return e.exit_code
    for r in out.collect():
        print(json.dumps(r.asDict(), default=str))
    return int(job_exit_code(out).first()[0])


if __name__ == "__main__":
    sys.exit(main())

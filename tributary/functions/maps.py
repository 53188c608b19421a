"""Guarded and retrying row maps (ops F2, F3).

A Python function applied to every row, in Arrow batches on the executors
(``mapInArrow``, so keys, integers and NULLs arrive as they are).  Failures are data, not task failures: each input row
gives one outcome row ``idx, ok, tries, value, error``.  The input order is
carried by the ``idx`` column; a global sort is only done when asked for.

Spark already retries whole tasks (``spark.task.maxFailures``); these
retries are per row, for flaky per-row work such as remote calls.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def _outcome_schema(idx_type: T.DataType, value_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("idx", idx_type),
        T.StructField("ok", T.BooleanType()),
        T.StructField("tries", T.IntegerType()),
        T.StructField("value", value_type),
        T.StructField("error", T.StringType()),
    ])


def _unwrap(v):
    if isinstance(v, (list, tuple)) and len(v) == 1:
        return v[0]
    return v


def retrying_map(df: DataFrame, fn, idx: str, inputs: list[str], value_type: T.DataType,
                 max_tries: int = 3, delay_seconds: float = 1.0) -> DataFrame:
    """call ``fn(*inputs)`` per row, up to ``max_tries`` times,
    ``delay_seconds`` apart; the last error is kept on the outcome row."""
    schema = _outcome_schema(df.schema[idx].dataType, value_type)
    cols = list(dict.fromkeys([idx] + list(inputs)))

    value_kind = to_arrow_type(value_type)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns))
            out_ok, out_tries, out_val, out_err = [], [], [], []
            for row in zip(*(column[c].to_pylist() for c in inputs)):  # exact integers, None for NULL
                tries, ok, val, err = 0, False, None, None
                while tries < max_tries:
                    tries += 1
                    try:
                        val, ok, err = _unwrap(fn(*row)), True, None
                        break
                    except Exception as e:
                        err = f"{type(e).__name__}: {e}"
                        if tries < max_tries and delay_seconds:
                            time.sleep(delay_seconds)
                out_ok.append(ok)
                out_tries.append(tries)
                out_val.append(val if ok else None)
                out_err.append(err)
            yield pa.RecordBatch.from_arrays(
                [column[idx], pa.array(out_ok, pa.bool_()), pa.array(out_tries, pa.int32()),
                 pa.array(out_val, value_kind), pa.array(out_err, pa.string())],
                ["idx", "ok", "tries", "value", "error"])

    return df.select(*cols).mapInArrow(run, schema)


def guarded_map(df: DataFrame, fn, idx: str, inputs: list[str], value_type: T.DataType,
                keep_failures: bool = False, ordered: bool = False) -> DataFrame:
    """call ``fn(*inputs)`` once per row; failing rows are dropped (or
    kept with ``ok = false`` when ``keep_failures``); one-element list
    results are unwrapped.  ``ordered`` sorts by ``idx``."""
    out = retrying_map(df, fn, idx, inputs, value_type, max_tries=1, delay_seconds=0)
    if not keep_failures:
        out = out.where("ok")
    if ordered:
        out = out.orderBy("idx")
    return out

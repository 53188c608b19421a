"""Level-by-level loops shared by the tree walk and the step-graph peel.

Every level is cut from its lineage with a reliable ``checkpoint()`` into the
cluster's shared checkpoint folder, so a lost executor never forces the
loop to recompute earlier levels, and plans stay shallow.  The size of the
next frontier is counted by the same job (an observed metric), so one
number per level reaches the driver and no extra job runs.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tributary.session import ensure_checkpoint_dir


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_counting(df: DataFrame, condition: Column | None = None) -> tuple[DataFrame, int]:
    """``cut`` plus the number of rows matching ``condition`` (all rows when
    None), counted by the same job through an observed metric -- so a loop
    needs no separate emptiness job per level."""
    obs = Observation(f"cut-{uuid.uuid4().hex[:8]}")
    flag = F.lit(True) if condition is None else condition
    observed = df.observe(obs, F.sum(F.when(flag, 1).otherwise(0)).alias("n"))
    out = cut(observed)
    return out, int(obs.get.get("n") or 0)


def in_place(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by ``key`` and kept on the executors' disks: the joins of
    a loop read it where it lies and only move their frontier.  Lost blocks
    come again from what ``df`` reads; unpersist it after the loop."""
    return df.repartition(key).persist(StorageLevel.DISK_ONLY)


def union_all(parts: list[DataFrame], empty: DataFrame) -> DataFrame:
    if not parts:
        return empty
    return reduce(lambda a, b: a.unionByName(b), parts)

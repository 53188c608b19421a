"""Explicit salting for many-to-one joins (a fallback where AQE is off, or a
single key is too large even for AQE's skew splits).

The many side gets a random salt in ``[0, buckets)`` (seeded; identical rows
of a hot key must still spread, so a content hash won't do).  Spark marks
such stages indeterminate and, if a map output is lost, re-runs the stages
that read it wholesale, so every row still joins exactly once.  The one
side -- unique per key -- is replicated once per salt value: a hot key
spreads over ``buckets`` join tasks, the one side grows ``buckets`` times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def salted_join(many: DataFrame, one: DataFrame, condition: Column | None, keys: list[tuple[str, str]],
                buckets: int, how: str = "left", seed: int = 17) -> DataFrame:
    """``many JOIN one`` on ``keys`` ([(many_col, one_col)]) plus any extra
    ``condition``; with ``buckets <= 1`` it is the plain join."""
    cond = None
    for lc, rc in keys:
        c = many[lc] == one[rc]
        cond = c if cond is None else cond & c
    if condition is not None:
        cond = cond & condition
    if buckets <= 1:
        return many.join(one, cond, how)
    salted_many = many.withColumn(SALT, F.floor(F.rand(seed) * buckets).cast("long"))
    salted_one = one.withColumn("_salt_r", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    cond2 = None
    for lc, rc in keys:
        c = salted_many[lc] == salted_one[rc]
        cond2 = c if cond2 is None else cond2 & c
    cond2 = cond2 & (salted_many[SALT] == salted_one["_salt_r"])
    if condition is not None:
        cond2 = cond2 & condition
    return salted_many.join(salted_one, cond2, how).drop(SALT, "_salt_r")

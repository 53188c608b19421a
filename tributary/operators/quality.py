"""Schema contracts, normalisation and validation rules (stated intent
S1, S3, S4).  Each check is a single aggregate pass over the data: one
``sum(when(violation))`` per rule, combined map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = T.StructType([T.StructField("column", T.StringType()),
                       T.StructField("rule", T.StringType()),
                       T.StructField("n_violations", T.LongType())])


def _flag(cond: Column) -> Column:
    return F.count(F.when(cond, 1))  # 0 on empty input


def check_contract(df: DataFrame, contract: dict[str, dict]) -> DataFrame:
    """``contract`` maps column -> rules: ``type`` (simple type name),
    ``nullable`` (bool), ``min``/``max``, ``values`` (allowed list),
    ``pattern`` (regex).  A missing column or a wrong type violates every
    row.  Output: ``column, rule, n_violations`` (one row per rule)."""
    present = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    checks: list[tuple[str, str, Column]] = []
    for col, rules in contract.items():
        if col not in present:
            checks.append((col, "missing", F.lit(True)))
            continue
        c = F.col(col)
        if "type" in rules:
            checks.append((col, "type", F.lit(present[col] != rules["type"])))
        if rules.get("nullable") is False:
            checks.append((col, "not_null", c.isNull()))
        if "min" in rules:
            checks.append((col, "min", c < F.lit(rules["min"])))
        if "max" in rules:
            checks.append((col, "max", c > F.lit(rules["max"])))
        if "values" in rules:
            checks.append((col, "values", c.isNotNull() & ~c.isin(*rules["values"])))
        if "pattern" in rules:
            checks.append((col, "pattern", c.isNotNull() & ~c.cast("string").rlike(rules["pattern"])))
    if not checks:
        return df.sparkSession.createDataFrame([], RESULT)
    agg = df.agg(*[_flag(cond).alias(f"c{i}") for i, (_, _, cond) in enumerate(checks)])
    pairs = [F.struct(F.lit(col).alias("column"), F.lit(rule).alias("rule"),
                      F.col(f"c{i}").alias("n_violations")) for i, (col, rule, _) in enumerate(checks)]
    return agg.select(F.inline(F.array(*pairs)))


def check_rules(df: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Named SQL conditions -> ``rule, n_pass, n_fail, n_unknown``
    (unknown = the condition is NULL) in one pass."""
    aggs = []
    for i, (_, cond) in enumerate(rules):
        e = F.expr(cond)
        aggs += [_flag(e).alias(f"p{i}"), _flag(~e).alias(f"f{i}"), _flag(e.isNull()).alias(f"u{i}")]
    agg = df.agg(*aggs)
    rows = [F.struct(F.lit(name).alias("rule"), F.col(f"p{i}").alias("n_pass"),
                     F.col(f"f{i}").alias("n_fail"), F.col(f"u{i}").alias("n_unknown"))
            for i, (name, _) in enumerate(rules)]
    return agg.select(F.inline(F.array(*rows)))


# Strings that could be integers: a superset of what Spark's string -> integral
# cast accepts (it trims characters <= U+0020 and allows a sign and a zero
# fraction).  Values outside it go straight to NULL, skipping the costly
# failure path of the cast itself; values inside are cast as usual.
_INTEGRAL_GUARD = r"^[\x00-\x20]*[+-]?[0-9]+(\.[0-9]*)?[\x00-\x20]*$"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _try_cast(src: Column, source_type: T.DataType, target: T.DataType) -> Column:
    cast = src.try_cast(target)
    if isinstance(source_type, T.StringType) and isinstance(target, _INTEGRAL):
        return F.when(src.rlike(_INTEGRAL_GUARD), cast)
    return cast


def normalize(df: DataFrame, schema: T.StructType, key: str | None = None) -> DataFrame:
    """S3: cast every column of ``schema`` with ``try_cast``; a value that
    was present but does not convert becomes NULL and its column name goes
    to ``_rejected`` (array).  Columns outside the schema are dropped."""
    out, bad = [], []
    for f in schema.fields:
        src = F.col(f.name)
        cast = _try_cast(src, df.schema[f.name].dataType, f.dataType)
        out.append(cast.alias(f.name))
        bad.append(F.when(src.isNotNull() & cast.isNull(), F.lit(f.name)))
    keep = [F.col(key)] if key and key not in schema.fieldNames() else []
    return df.select(*keep, *out, F.array_compact(F.array(*bad)).alias("_rejected"))


def reject_counts(normalized: DataFrame) -> DataFrame:
    """Rejected values per column of a normalised table."""
    return (normalized.select(F.explode("_rejected").alias("column"))
            .groupBy("column").agg(F.count(F.lit(1)).alias("n_rejected")))

"""Helpers the training-data operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import work_dir

#: Ways a group of rows with one key is split before anything gathers it.
SALTS = 256


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` as a table under the shared checkpoint folder: written once and
    read back, so a lost executor never makes Spark repeat what made it."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    schema = df.schema
    df.write.options(**options).parquet(path)
    return spark.read.schema(schema).parquet(path)


def fresh(*parts: str) -> str:
    """A column name that no input column has."""
    return "_".join(("_t", *parts, uuid.uuid4().hex[:6]))


def as_column(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(f"`{name}`").cast(kind)


def with_group_min(df: DataFrame, key: str, value: str, out: str, salts: int = SALTS) -> DataFrame:
    """``df`` plus ``out``: the smallest ``value`` among rows with the same
    ``key`` (null where the key is null or all values are).

    No task gets a whole group: rows are dealt by (key, salt of the value),
    reduced there, and the group's minimum comes back as one row for each
    (key, salt) that exists -- never more rows than ``df`` has.
    """
    salt, low, salts_of = fresh("salt"), fresh("low"), fresh("salts")
    dealt = df.withColumn(salt, F.pmod(F.xxhash64(F.col(value)), F.lit(salts)).cast("int"))
    part = dealt.where(F.col(key).isNotNull()).groupBy(key, salt).agg(F.min(value).alias(low))
    top = part.groupBy(key).agg(F.min(low).alias(out), F.collect_list(salt).alias(salts_of))
    back = top.select(key, out, F.explode(salts_of).alias(salt))
    return dealt.join(back, [key, salt], "left").select(*df.columns, out)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

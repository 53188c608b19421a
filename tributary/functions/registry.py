"""Named transforms (op F1): ``DataFrame -> DataFrame`` functions registered
by name and applied with ``df.transform``.  Re-registering replaces the
function with a warning; an unknown name raises ActionNotFound."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.errors import ActionNotFound

Transform = Callable[..., DataFrame]
_REGISTRY: dict[str, Transform] = {}


def register(name: str) -> Callable[[Transform], Transform]:
    def inner(fn: Transform) -> Transform:
        if name in _REGISTRY:
            logging.warning("replacing the transform called %r", name)
        _REGISTRY[name] = fn
        return fn
    return inner


def get(name: str) -> Transform:
    if name not in _REGISTRY:
        raise ActionNotFound(f"no transform is called {name!r}; registered: {', '.join(names()) or 'none'}")
    return _REGISTRY[name]


def names() -> list[str]:
    return sorted(_REGISTRY)


def apply(df: DataFrame, name: str, **params) -> DataFrame:
    return df.transform(get(name), **params)


def apply_chain(df: DataFrame, steps: list[tuple[str, dict]]) -> DataFrame:
    for name, params in steps:
        df = apply(df, name, **params)
    return df


@register("identity")
def _identity(df: DataFrame) -> DataFrame:
    return df


@register("filter_rows")
def _filter_rows(df: DataFrame, condition: str) -> DataFrame:
    """Keep rows matching a SQL condition."""
    return df.where(F.expr(condition))


@register("select_columns")
def _select_columns(df: DataFrame, columns: list[str] | dict[str, str]) -> DataFrame:
    """Project columns; a dict maps output name -> SQL expression."""
    if isinstance(columns, dict):
        return df.select(*[F.expr(e).alias(n) for n, e in columns.items()])
    return df.select(*columns)


@register("with_partition_value")
def _with_pv(df: DataFrame, partition_value: str) -> DataFrame:
    return df.withColumn("partition_value", F.lit(str(partition_value)))

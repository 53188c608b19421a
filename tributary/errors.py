"""Exceptions and the exit-code table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class TributaryError(Exception):
    exit_code = 1
    critical = False


class InvalidConfigError(TributaryError):
    """A named location / step is missing from the configuration."""
    exit_code = 6


class ClientNotFound(TributaryError):
    """A location type has no registered path rule."""
    exit_code = 6


class InvalidSourceError(TributaryError):
    """A source partition does not exist (always stops a run)."""
    exit_code = 2
    critical = True


class MalformedRowsError(TributaryError):
    """Rows of a source do not fit its schema and there is no place for them."""
    exit_code = 10


class ActionNotFound(TributaryError):
    exit_code = 4


class CycleError(TributaryError):
    """The step graph (or an item tree) contains a cycle."""
    exit_code = 4


# Exit codes and their meaning, as documented by the framework
# being re-built (code, name), in natural order.
EXIT_CODES = [
    (0, "Success"),
    (1, "Catch All for Errors"),
    (2, "Invalid Source"),
    (3, "Invalid Destination"),
    (4, "Invalid Pipeline"),
    (5, "Invalid Credentials"),
    (6, "Invalid Configuration"),
    (7, "Invalid Run Configuration"),
    (8, "Invalid Load Configuration"),
    (9, "Invalid Extract Configuration"),
    (10, "Invalid Schema"),
    (11, "Invalid Resource"),
    (12, "Invalid Source Configuration"),
    (13, "Invalid Destination Configuration"),
    (14, "Invalid Normalize Configuration"),
    (15, "Invalid Loader Configuration"),
    (16, "Invalid Extract Info"),
    (17, "Invalid Load Info"),
    (18, "Invalid Normalize Info"),
    (19, "Invalid Step Info"),
    (20, "Invalid Pipeline Trace"),
    (21, "Invalid Pipeline Step Trace"),
]


def exit_code_table(spark: SparkSession) -> DataFrame:
    """The 22-row code table (fixed size, safe to broadcast)."""
    return spark.createDataFrame(EXIT_CODES, "code INT, name STRING")


def exit_code_of(error: BaseException | None) -> int:
    if error is None:
        return 0
    return getattr(error, "exit_code", 1)

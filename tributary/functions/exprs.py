"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the framework being re-built.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"      # timestamps as text (%Y-%m-%d %H:%M:%S)
DATE_FORMAT = "yyyy-MM-dd"             # partition days (%Y-%m-%d)
ROOT_MARKER = "root:"                  # parent paths: <drive>/root:<path>
SUBFOLDER_MARKER = ":/"                # sub-folder starts after the first ':/'
RUN_ID_SEPARATOR = "#$"                # run ids: <step>#$<uuid>


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def path_after_root(parent_path) -> Column:
    """Text after ``root:`` in a parent path, '' when there is no marker."""
    return F.coalesce(F.get(F.split(col(parent_path), ROOT_MARKER), 1), F.lit(""))


def full_path(path, name) -> Column:
    """``path/name``, or just ``name`` when path is ''."""
    return F.when(col(path) != "", F.concat(col(path), F.lit("/"), col(name))).otherwise(col(name))


def subfolder(parent_path) -> Column:
    """Text after the first ``:/`` in a parent path, '' when absent."""
    p = col(parent_path)
    pos = F.instr(p, SUBFOLDER_MARKER)
    return F.when(pos > 0, F.substring(p, pos + 2, F.length(p))).otherwise(F.lit(""))


def normal_path(path) -> Column:
    """A path without empty, ``.`` and (as far as a folder stands before them)
    ``..`` steps: a stack built over the steps.  At the root of an absolute path
    ``..`` stays there; a relative path may begin with some, and is ``.`` if
    nothing is left."""
    p = col(path)
    absolute = F.startswith(p, F.lit("/"))
    steps = F.filter(F.split(p, "/"), lambda s: (s != "") & (s != "."))

    def push(stack: Column, step: Column) -> Column:
        above = F.coalesce(F.get(stack, F.size(stack) - 1), F.lit(".."))
        return (F.when(step != "..", F.concat(stack, F.array(step)))
                 .when(above != "..", F.slice(stack, F.lit(1), F.size(stack) - 1))
                 .when(absolute, stack).otherwise(F.concat(stack, F.array(step))))

    kept = F.array_join(F.aggregate(steps, F.array().cast("array<string>"), push), "/")
    return F.when(absolute, F.concat(F.lit("/"), kept)).when(kept == "", F.lit(".")).otherwise(kept)


def join_local(root, *parts) -> Column:
    """Join folder parts to one normal path (no trailing slash)."""
    return normal_path(F.concat_ws("/", col(root), *[col(p) for p in parts]))


def ts_text(c) -> Column:
    return F.date_format(col(c), TS_FORMAT)


def hms(seconds) -> Column:
    """Whole seconds as ``HH:MM:SS``; hours are not bounded."""
    s = col(seconds)
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60)


def duration_seconds(start, end) -> Column:
    """Whole seconds between two timestamps (fractions truncated)."""
    return F.timestamp_diff("SECOND", col(start), col(end))


def add_years(ts, years: int = 1) -> Column:
    """``ts`` plus calendar years (29 Feb -> 28 Feb)."""
    return col(ts) + F.make_interval(F.lit(years))


def make_run_id(step, suffix) -> Column:
    return F.concat(col(step), F.lit(RUN_ID_SEPARATOR), col(suffix))


def run_id_step(run_id) -> Column:
    return F.substring_index(col(run_id), RUN_ID_SEPARATOR, 1)


def run_id_suffix(run_id) -> Column:
    return F.substring_index(col(run_id), RUN_ID_SEPARATOR, -1)


def error_payload(message) -> Column:
    """``{"status": -1, "error": {"message": ...}}`` as JSON text."""
    return F.to_json(F.struct(F.lit(-1).alias("status"),
                              F.struct(col(message).alias("message")).alias("error")))

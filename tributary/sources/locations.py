"""Named locations resolved to partition folders (ops A1-A8).

A *location* is configuration: ``{name: {"type": ..., "directory_path": ...}}``.
A *path rule* registered per type turns (location, partition value) into the
folder of that partition.  Reads always take an explicit schema, and the
partition value is carried as an opaque ``partition_value STRING`` column.

Built-in types:

``directory``
    Spark layout ``<base>/partition_value=<pv>`` by default, so that many
    partitions can be written in one job (``partitionBy`` + dynamic overwrite)
    and pruned on read.  ``"layout": "plain"`` gives ``<base>/<pv>``.
``snowflake_landing_zone``
    ``<base>/<pv>-snowflake``: files only, one folder per landed partition.
"""

from __future__ import annotations

import fnmatch
import json
import logging
import re
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.errors import ClientNotFound, InvalidConfigError, InvalidSourceError
from tributary.session import filesystem
from tributary.sources.csvsplit import read_csv

PV = "partition_value"

# Location type names as job configs spell them, and the
# folder suffix of a landed partition.
DIRECTORY = "directory"
LANDING_ZONE = "snowflake_landing_zone"
LANDING_SUFFIX = "-snowflake"

PathRule = Callable[[dict, str], str]
FolderRule = Callable[[dict, str], "str | None"]
_RULES: dict[str, PathRule] = {}
_FOLDERS: dict[str, FolderRule] = {}

# Characters that Spark writes as %XX in partition folder names.
ESCAPED = frozenset("\"#%'*/:=?\\{[]^\x7f") | frozenset(map(chr, range(1, 32)))


def encode(pv: str) -> str:
    """A partition value as part of a folder name, as Spark's own writers
    spell it -- used by every path rule, so all writers and readers agree."""
    return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in pv)


def decode(name: str) -> str:
    """The partition value of an encoded name."""
    return re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), name)


def register_location_type(name: str, folder: FolderRule | None = None) -> Callable[[PathRule], PathRule]:
    """Register a path rule for a location type; registering a type again
    replaces its rule.  ``folder`` is the rule's inverse: the partition value of
    a folder directly under the location's base, None for other folders."""

    def inner(rule: PathRule) -> PathRule:
        if name in _RULES:
            logging.warning("replacing the path rule of location type %r", name)
        _RULES[name] = rule
        if folder is not None:
            _FOLDERS[name] = folder
        return rule

    return inner


def _base(cfg: dict) -> str:
    base = cfg.get("directory_path")
    if not base:
        raise InvalidConfigError(f"location has no directory_path: {cfg}")
    return str(base).rstrip("/")


def _hive(cfg: dict) -> bool:
    return cfg["type"] == DIRECTORY and cfg.get("layout", "hive") != "plain"


def _directory_folder(cfg: dict, name: str) -> str | None:
    if cfg.get("layout", "hive") == "plain":
        return decode(name)
    return decode(name.removeprefix(f"{PV}=")) if name.startswith(f"{PV}=") else None


@register_location_type(DIRECTORY, _directory_folder)
def _directory_rule(cfg: dict, pv: str) -> str:
    if cfg.get("layout", "hive") == "plain":
        return f"{_base(cfg)}/{encode(pv)}"
    return f"{_base(cfg)}/{PV}={encode(pv)}"


@register_location_type(LANDING_ZONE, lambda cfg, name: decode(name.removesuffix(LANDING_SUFFIX)) if name.endswith(LANDING_SUFFIX) else None)
def _landing_rule(cfg: dict, pv: str) -> str:
    return f"{_base(cfg)}/{encode(pv)}{LANDING_SUFFIX}"


def location_types() -> list[str]:
    return sorted(_RULES)


def get_config(locations: dict, name: str) -> dict:
    """Config of a named location; unknown name -> InvalidConfigError."""
    if name not in locations:
        raise InvalidConfigError(f"no location is called {name!r}")
    cfg = dict(locations[name])
    if cfg.get("type") not in _RULES:
        raise ClientNotFound(f"no location type is called {cfg.get('type')!r}")
    return cfg


def partition_path(locations: dict, name: str, pv: str) -> str:
    cfg = get_config(locations, name)
    return _RULES[cfg["type"]](cfg, str(pv))


def with_partition(schema: T.StructType) -> T.StructType:
    """Schema plus the opaque partition column (typed STRING, never inferred)."""
    if PV in schema.fieldNames():
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(PV, T.StringType(), True)])


#: What is written comes back: quotes are doubled, line feeds stay inside
#: their field.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "lineSep": "\n",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def csv_options(cfg: dict) -> dict:
    """Spark reads a quoted empty text as missing, too, unless missing values
    have a mark of their own: a location's ``null_value``."""
    return {**CSV_OPTIONS, **({"nullValue": cfg["null_value"]} if "null_value" in cfg else {})}


def _reader(spark: SparkSession, fmt: str, schema: T.StructType, options: dict | None):
    r = spark.read.format(fmt).schema(schema)
    if fmt == "csv":
        r = r.options(**CSV_OPTIONS)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r


def read_partition(spark: SparkSession, locations: dict, name: str, pv: str,
                   schema: T.StructType, fmt: str = "parquet",
                   options: dict | None = None) -> DataFrame:
    """One partition of a source location (A2).  A missing partition raises
    InvalidSourceError (A3); the check happens when the relation is resolved,
    before any job runs.  CSV files are read by many tasks each (``csvsplit``);
    a location with ``"split": False`` leaves each to one, with Spark's reader."""
    path = partition_path(locations, name, pv)
    try:
        cfg = get_config(locations, name)
        if fmt == "csv" and cfg.get("split", True):
            df = read_csv(spark, path, schema, {**csv_options(cfg), **(options or {})})
        else:
            df = _reader(spark, fmt, schema, {**(csv_options(cfg) if fmt == "csv" else {}), **(options or {})}).load(path)
    except AnalysisException as e:  # PATH_NOT_FOUND
        if (e.getCondition() or "").startswith("PATH_NOT_FOUND"):
            raise InvalidSourceError(f"no folder at {path}") from e
        raise
    return df.withColumn(PV, F.lit(str(pv)))


def read_csv_partition(spark: SparkSession, locations: dict, name: str, pv: str,
                       schema: T.StructType, corrupt_col: str = "_corrupt_record") -> DataFrame:
    """CSV source partition (A8): header row, explicit schema, malformed rows
    kept with their raw text in ``corrupt_col`` (PERMISSIVE mode)."""
    full = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType(), True)])
    return read_partition(spark, locations, name, pv, full, fmt="csv",
                          options={"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col})


def write_partition(df: DataFrame, locations: dict, name: str, pv: str,
                    fmt: str = "parquet", mode: str = "overwrite",
                    options: dict | None = None) -> str:
    """Write a DataFrame as one partition of a sink location (A4/A5).  The
    folder is created by the write; the partition column is not stored in
    the files (it is the folder)."""
    path = partition_path(locations, name, pv)
    out = df.drop(PV) if PV in df.columns else df
    w = out.write.format(fmt).mode(mode)
    if fmt == "csv":
        w = w.options(**csv_options(get_config(locations, name)))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)
    return path


def write_partitions(df: DataFrame, locations: dict, name: str,
                     fmt: str = "parquet") -> str:
    """Write many partitions in one job (A4 set form).  Needs a ``directory``
    location with the default layout; only the partitions present in ``df``
    are replaced (dynamic overwrite), the others survive.

    ``rebalance`` lets AQE split a partition value that holds a large share of
    the rows over several tasks instead of funnelling it through one."""
    cfg = get_config(locations, name)
    if cfg["type"] != DIRECTORY or cfg.get("layout", "hive") != "hive":
        raise InvalidConfigError("write_partitions needs a directory location with hive layout")
    (df.hint("rebalance", PV).write.format(fmt).mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(PV).save(_base(cfg)))
    return _base(cfg)


def read_partitions(spark: SparkSession, locations: dict, name: str,
                    schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """All partitions of a location.  In the default layout filters on
    ``partition_value`` prune folders; in the others the value comes from each
    file's folder.  The explicit schema keeps ``partition_value`` a STRING
    (no type inference of values like ``2023-04-31``)."""
    cfg = get_config(locations, name)
    if not _hive(cfg):
        if present_partitions(spark, locations, name).isEmpty():
            return spark.createDataFrame([], with_partition(schema))
        suffix = LANDING_SUFFIX if cfg["type"] == LANDING_ZONE else ""
        df = _reader(spark, fmt, schema, None).load(f"{_base(cfg)}/*{suffix}")
        return df.withColumn(PV, _folder_value(F.col("_metadata.file_path"), suffix))
    return spark.read.format(fmt).schema(with_partition(schema)).load(_base(cfg))


def _folder_value(path: Column, suffix: str = "") -> Column:
    """The partition value of the folder a file lies in, from its URI.  ('+'
    stands for itself in both steps: the URI's own %XX, then the folder
    name's.)"""
    def once(c: Column) -> Column:
        return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))

    name = once(F.element_at(F.split(path, "/"), -2))
    return once(F.substring(name, F.lit(1), F.length(name) - len(suffix)))


def folder_names(spark: SparkSession, base: str) -> list[str]:
    """Names of the folders directly under ``base``, on any store Spark reads
    (one listing by the driver; none if there is no such folder)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def _hadoop(spark: SparkSession, base: str):
    """(file system, path maker) of a folder on any store Spark reads."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(base).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), make


def committed_folders(spark: SparkSession, base: str) -> list[str]:
    """Those of ``folder_names`` whose write has ended (its success mark is there)."""
    names = folder_names(spark, base)
    fs, path = _hadoop(spark, base)
    return [n for n in names if fs.exists(path(f"{base}/{n}/_SUCCESS"))]


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put one folder in another's place, on the same store."""
    fs, path = _hadoop(spark, target)
    fs.delete(path(target), True)
    if not fs.rename(path(source), path(target)):
        raise OSError(f"could not move {source} to {target}")


def delete_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _hadoop(spark, folder)
    fs.delete(path(folder), True)


def publish(spark: SparkSession, base: str, staged: str, moves: list[tuple[str | None, str]]) -> None:
    """Make staged folders the folders they are to replace: ``moves`` are (name
    under ``staged``, or None for an empty folder; name under ``base``), all on one
    store.

    What is to be moved is written down first, so that ``publish_pending`` can
    end a publication that broke off.  One may run under a base at a time."""
    from tributary.session import filesystem
    fs, root = filesystem(base)
    fs.create_dir(f"{root}/_pending", recursive=True)
    with fs.open_output_stream(f"{root}/_pending/{uuid.uuid4().hex}.json") as fh:
        fh.write(json.dumps({"staged": staged, "moves": moves}).encode("utf-8"))
    publish_pending(spark, base)


def publish_pending(spark: SparkSession, base: str) -> int:
    """End all publications under ``base`` that are written down; how many.
    A move that was made before is not made again."""
    import pyarrow.fs as pafs

    from tributary.session import filesystem
    files, root = filesystem(base)
    fs, path = _hadoop(spark, base)
    notes = sorted(f.path for f in files.get_file_info(pafs.FileSelector(f"{root}/_pending", allow_not_found=True)) if f.is_file)
    for note in notes:
        with files.open_input_stream(note) as fh:
            todo = json.loads(fh.read().decode("utf-8"))
        for name, to in todo["moves"]:
            target = path(f"{base}/{to}")
            if name is None:
                fs.delete(target, True)
                fs.mkdirs(target)
                continue
            source = f"{todo['staged']}/{name}"
            if fs.exists(path(source)):  # else it was moved before
                replace_folder(spark, source, f"{base}/{to}")
        files.delete_file(note)
        fs.delete(path(todo["staged"]), True)
    pending = path(f"{base}/_pending")
    if fs.exists(pending) and not any(not s.getPath().getName().startswith(".") for s in fs.listStatus(pending)):
        fs.delete(pending, True)
    return len(notes)


def present_partitions(spark: SparkSession, locations: dict, name: str,
                       fmt: str = "parquet") -> DataFrame:
    """Partition values present in a location of any type with a folder rule
    (one row each).  Folders decide, also empty ones; nothing is opened."""
    cfg = get_config(locations, name)
    if cfg["type"] not in _FOLDERS:
        raise InvalidConfigError(f"location type {cfg['type']!r} has no folder rule")
    values = [_FOLDERS[cfg["type"]](cfg, n) for n in folder_names(spark, _base(cfg))]
    return spark.createDataFrame([(v,) for v in values if v is not None], f"{PV} STRING")


def missing_partitions(spark: SparkSession, locations: dict, name: str,
                       requested: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Requested partition values with no folder (A3 set form)."""
    present = present_partitions(spark, locations, name, fmt)
    return requested.select(F.col(PV).cast("string").alias(PV)).join(present, PV, "left_anti")


def date_range_values(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Partition values for every day in [start, end] as ``yyyy-MM-dd``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("d")
    ).select(F.date_format("d", "yyyy-MM-dd").alias(PV))


#: Folders that one task of ``files_below`` lists.
FOLDERS_PER_TASK = 8

FILE_ROW = "path STRING, below STRING, name STRING, length LONG, modificationTime TIMESTAMP"


def _skipped(name: str) -> bool:
    """Names that Spark's file sources skip."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def files_below(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Files whose names match ``pattern`` in a folder and all folders below it:
    ``path, below`` (the path after the folder's)``, name, length, modificationTime``.

    Only the names of the folders directly under ``path`` come to the driver;
    tasks list these, FOLDERS_PER_TASK each, with all that is below them, through any
    filesystem pyarrow can open.  Spark's own file sources hold every file's
    status on the driver, too much for millions of files."""
    from pyarrow.fs import FileType

    fs, base = filesystem(path)
    if fs.get_file_info(base).type != FileType.Directory:
        raise InvalidSourceError(f"no folder at {path}")
    folders = [None, *folder_names(spark, path)]  # None: the files of ``path`` itself
    root = path.rstrip("/")

    def run(batches):
        import pandas as pd
        from pyarrow.fs import FileSelector, FileType

        fs, base = filesystem(root)
        for pdf in batches:
            for i in pdf["id"]:
                at = base if folders[i] is None else f"{base}/{folders[i]}"
                rows = []
                for f in fs.get_file_info(FileSelector(at, recursive=folders[i] is not None)):
                    below = f.path[len(base):].lstrip("/")
                    if f.type == FileType.File and fnmatch.fnmatchcase(f.base_name, pattern) and not any(map(_skipped, below.split("/"))):
                        rows.append((f"{root}/{below}", below, f.base_name, f.size, f.mtime))
                if rows:
                    out = pd.DataFrame(rows, columns=["path", "below", "name", "length", "modificationTime"])
                    out["modificationTime"] = pd.to_datetime(out["modificationTime"], utc=True)
                    yield out

    return spark.range(0, len(folders), 1, -(-len(folders) // FOLDERS_PER_TASK)).mapInPandas(run, FILE_ROW)


def list_files(spark: SparkSession, path: str, file_extension: str, recursive: bool = False) -> DataFrame:
    """Files of one extension in a folder (A6): ``path, name, length,
    modificationTime``.  The file bodies are pruned from the scan.  Spark
    skips names starting with ``.`` or ``_`` and lists only files.
    ``recursive`` takes the folders below it, too, which tasks list
    (``files_below``)."""
    if recursive:
        return files_below(spark, path, f"*.{file_extension}").drop("below")
    try:
        df = (spark.read.format("binaryFile")
              .option("pathGlobFilter", f"*.{file_extension}")
              .option("recursiveFileLookup", "false")
              .load(path))
    except AnalysisException as e:
        if (e.getCondition() or "").startswith("PATH_NOT_FOUND"):
            raise InvalidSourceError(f"no folder at {path}") from e
        raise
    return df.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "length",
        "modificationTime",
    )


def count_files(spark: SparkSession, path: str, file_extension: str, recursive: bool = False) -> DataFrame:
    """Number of files of one extension (A7); 0 when none match."""
    return list_files(spark, path, file_extension, recursive).agg(F.count(F.lit(1)).alias("n_files"))


def landed_partitions(spark: SparkSession, locations: dict, name: str,
                      schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read back every landed partition of a landing zone by glob, recovering
    the folder name from each row's file path."""
    cfg = get_config(locations, name)
    df = spark.read.format(fmt).schema(schema).load(f"{_base(cfg)}/*{LANDING_SUFFIX}")
    pv = _folder_value(F.col("_metadata.file_path"), LANDING_SUFFIX)
    return df.withColumn("landing_dir", F.concat(pv, F.lit(LANDING_SUFFIX))).withColumn(PV, pv)


def requested_values(spark: SparkSession, values: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(str(v),) for v in values], f"{PV} STRING")


# Entry points named after the reference's client factory.

def get_source(spark: SparkSession, locations: dict, name: str, partition_value: str,
               schema: T.StructType, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """The source partition of a named location as a DataFrame."""
    return read_partition(spark, locations, name, partition_value, schema, fmt, options)


def get_sink(locations: dict, name: str, partition_value: str) -> str:
    """The sink folder of a named location for one partition (created by the write)."""
    return partition_path(locations, name, partition_value)


def list_partition_files(spark: SparkSession, locations: dict, name: str, partition_value: str,
                         file_extension: str) -> DataFrame:
    """Files of one extension in a location's partition folder."""
    return list_files(spark, partition_path(locations, name, partition_value), file_extension)


def count_partition_files(spark: SparkSession, locations: dict, name: str, partition_value: str,
                          file_extension: str) -> DataFrame:
    """How many such files (A7); 0 when none match."""
    return count_files(spark, partition_path(locations, name, partition_value), file_extension)

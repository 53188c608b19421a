"""Message files as a table (ops C1-C3), plus a one-file-per-row writer.

The scan is Spark's ``binaryFile`` source, or, for files dealt over folders,
the tasks' own listing (``locations.files_below``); parsing each file is a small
per-row helper (the standard library's RFC 822 parser) run in Arrow batches
by ``mapInPandas``.  Everything after parsing is JVM-side.
"""

from __future__ import annotations

from email import policy
from email.parser import BytesParser
from email.utils import getaddresses, parsedate_to_datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.session import filesystem
from tributary.sources.locations import files_below

#: Files that one task writes or reads when files are dealt over folders, and
#: how many of them lie in one folder.
FILES_PER_TASK, FILES_PER_FOLDER = 2_000, 1_000
#: Bytes of files that a task reads before it hands on what it parsed.
HELD_BYTES = 64 << 20

MESSAGE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("email", T.StringType()),
    T.StructField("sender", T.StringType()),
    T.StructField("recipients", T.ArrayType(T.StringType())),
    T.StructField("cc", T.ArrayType(T.StringType())),
    T.StructField("bcc", T.ArrayType(T.StringType())),
    T.StructField("timestamp", T.LongType()),
    T.StructField("path", T.StringType()),
    T.StructField("error", T.StringType()),
])


def write_files(df: DataFrame, out_dir: str, name_col: str, content_col: str,
                in_folders: bool = False) -> tuple[int, int]:
    """Write each row's bytes to ``out_dir/<name>`` from the executors.

    File names are deterministic, so a retried task rewrites the same files
    (idempotent).  Returns (files, bytes); only two numbers reach the driver.
    ``in_folders`` is for many files: they are dealt by their names over tasks
    and over folders ``out_dir/<number>`` of about FILES_PER_FOLDER files, as
    many as there are rows."""
    rows = df.select(F.col(name_col).alias("name"), F.col(content_col).alias("content"), F.lit("").alias("folder"))
    if in_folders:
        n = df.count()
        folder = F.pmod(F.xxhash64("name"), F.lit(max(1, -(-n // FILES_PER_FOLDER))))
        rows = rows.withColumn("folder", F.concat(folder.cast("string"), F.lit("/"))).repartition(
            max(1, -(-n // FILES_PER_TASK)), "folder")

    def write(batches):
        fs, base = filesystem(out_dir)
        made = {""}
        fs.create_dir(base, recursive=True)
        for pdf in batches:
            sizes = []
            for name, content, folder in zip(pdf["name"], pdf["content"], pdf["folder"]):
                data = bytes(content)
                if folder not in made:
                    fs.create_dir(f"{base}/{folder}", recursive=True)
                    made.add(folder)
                with fs.open_output_stream(f"{base}/{folder}{name}") as fh:
                    fh.write(data)
                sizes.append(len(data))
            yield pd.DataFrame({"n": [len(sizes)], "bytes": [sum(sizes)]})

    fs, base = filesystem(out_dir)
    fs.create_dir(base, recursive=True)
    row = (rows.mapInPandas(write, "n long, bytes long")
               .agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first())
    return int(row["n"] or 0), int(row["bytes"] or 0)


def render_messages(rows: DataFrame) -> DataFrame:
    """RFC 822 text for rows ``id, sender, to1, to2, cc1, epoch, body``
    (JVM-side string building)."""
    # Wall-clock UTC without the session time zone: epoch + seconds on a
    # zone-less timestamp.
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("epoch"))
    date = F.date_format(utc, "dd MMM yyyy HH:mm:ss")
    header = F.concat_ws(
        "\r\n",
        F.concat(F.lit("From: "), "sender"),
        F.concat(F.lit("To: "), "to1", F.lit(", "), "to2"),
        F.when(F.col("cc1").isNotNull(), F.concat(F.lit("Cc: "), "cc1")),
        F.concat(F.lit("Date: "), date, F.lit(" +0000")),
        F.concat(F.lit("Subject: message "), F.col("id").cast("string")),
    )
    text = F.concat(header, F.lit("\r\n\r\n"), F.col("body"), F.lit("\r\n"))
    return rows.select(
        F.concat(F.col("id").cast("string"), F.lit(".eml")).alias("file_name"),
        F.encode(text, "UTF-8").alias("content"))


def _addresses(msg, header: str) -> list[str]:
    values = msg.get_all(header) or []
    return [addr for _, addr in getaddresses([str(v) for v in values]) if addr]


def parse_message(path: str, content: bytes) -> dict:
    """One message file -> one record (the per-row helper)."""
    stem = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
    try:
        msg = BytesParser(policy=policy.compat32).parsebytes(bytes(content))
        date = msg.get("Date")
        ts = int(parsedate_to_datetime(date).timestamp()) if date else None
        body = msg.get_payload(decode=False)
        if isinstance(body, list):
            body = "".join(part.get_payload() for part in body)
        return {
            "id": int(stem) if stem.isdigit() else None,
            "email": (body or "").strip(),
            "sender": (_addresses(msg, "From") or [None])[0],
            "recipients": _addresses(msg, "To"),
            "cc": _addresses(msg, "Cc"),
            "bcc": _addresses(msg, "Bcc"),
            "timestamp": ts,
            "path": path,
            "error": None,
        }
    except Exception as e:  # malformed file: keep the row, say why
        return {"id": int(stem) if stem.isdigit() else None, "email": None, "sender": None,
                "recipients": [], "cc": [], "bcc": [], "timestamp": None,
                "path": path, "error": f"{type(e).__name__}: {e}"}


def _table(recs: list[dict]) -> pd.DataFrame:
    out = pd.DataFrame.from_records(recs, columns=MESSAGE_SCHEMA.fieldNames())
    out["id"] = out["id"].astype("Int64")
    out["timestamp"] = out["timestamp"].astype("Int64")
    return out


def _parse_batches(batches):
    for pdf in batches:
        yield _table([parse_message(p, c) for p, c in zip(pdf["path"], pdf["content"])])


def _reads_and_parses(root: str):
    """Parser of rows ``path, below`` whose files lie at ``<root>/<below>``."""
    def run(batches):
        fs, base = filesystem(root)
        for pdf in batches:
            recs, held = [], 0
            for path, below in zip(pdf["path"], pdf["below"]):
                with fs.open_input_stream(f"{base}/{below}") as fh:
                    content = fh.read()
                recs.append(parse_message(path, content))
                held += len(content)
                if held >= HELD_BYTES:
                    yield _table(recs)
                    recs, held = [], 0
            if recs:
                yield _table(recs)

    return run


def read_messages(spark: SparkSession, path: str, pattern: str = "*.eml", recursive: bool = False) -> DataFrame:
    """Message table (C1): one row per file under ``path`` matching
    ``pattern``; unparsable files keep a row with ``error`` set.

    ``recursive`` takes the folders below ``path``, too; then tasks list and
    read the files (``locations.files_below``), FILES_PER_TASK each, and nothing
    of a file comes to the driver."""
    if recursive:
        files = files_below(spark, path, pattern)
        tasks = max(1, -(-files.count() // FILES_PER_TASK))
        return files.select("path", "below").repartition(tasks, "path").mapInPandas(_reads_and_parses(path), MESSAGE_SCHEMA)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .load(path).select("path", "content"))
    return files.mapInPandas(_parse_batches, MESSAGE_SCHEMA)


def senders(messages: DataFrame) -> DataFrame:
    """Sender of each message."""
    return messages.select("id", "sender")


def recipients_long(messages: DataFrame) -> DataFrame:
    """Recipients in long form (C3): one row per (message, position); a
    message without recipients keeps one row with NULLs."""
    return messages.select("id", F.posexplode_outer("recipients").alias("pos", "recipient"))

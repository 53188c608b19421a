"""Remote document-library listings as item tables (ops B1-B6, B8, B9).

The remote service answers one folder page at a time.  Here a listing is a
DataFrame of pages (raw JSON text), and everything the client did item by
item -- parsing, web-URL lookups, path resolution, recursive walks,
download plans -- becomes column expressions and joins over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.errors import CycleError
from tributary.functions import exprs as X
from tributary.operators import graph as G
from tributary.operators.frontier import cut, cut_counting, union_all

# Field names of the remote listing format.
DOWNLOAD_URL = "@microsoft.graph.downloadUrl"
NEXT_LINK = "@odata.nextLink"

ITEM_STRUCT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("folder", T.StructType([T.StructField("childCount", T.IntegerType())])),
    T.StructField("file", T.StructType([T.StructField("mimeType", T.StringType())])),
    T.StructField("parentReference", T.StructType([T.StructField("path", T.StringType())])),
    T.StructField(DOWNLOAD_URL, T.StringType()),
])
PAGE_SCHEMA = T.StructType([
    T.StructField("value", T.ArrayType(ITEM_STRUCT)),
    T.StructField(NEXT_LINK, T.StringType()),
])
DRIVE_PAGE_SCHEMA = T.StructType([
    T.StructField("value", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()), T.StructField("name", T.StringType())]))),
])
DETAIL_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("webUrl", T.StringType())])

ITEM_COLUMNS = ["id", "name", "type", "mimeType", "uri", "path", "fullpath", "filename"]


# ---------------------------------------------------------------- pages ----

def item_pages(items: DataFrame, page_size: int = 200) -> DataFrame:
    """Render an item table (``id, parent_id, name, type, pp, mime, dl``) as
    listing pages, one row per (folder, page): ``page_key, parent_id,
    page_no, body``.  Pages link to the next one; the last has no link.

    Items go to pages by a hash of their id, so no folder -- however large --
    is ever collected into one row or one sort: each page holds about
    ``page_size`` items.  Empty pages still exist, keeping every chain whole.
    """
    # One row per folder, used twice below: materialise it so the items are
    # scanned twice (count, then assign), not three times.
    # Every folder gets at least one (possibly empty) page, as the service
    # answers an empty folder with an empty listing.
    children = items.groupBy("parent_id").agg(F.count(F.lit(1)).alias("n"))
    folders = items.where(F.col("type") == "folder").select(
        F.col("id").alias("parent_id"), F.lit(0).cast("long").alias("n"))
    counts = cut(children.unionByName(folders).groupBy("parent_id").agg(F.sum("n").alias("n"))
                 .withColumn("n_pages", F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(page_size)))))
    entry = F.struct(
        F.col("id").alias("id"),
        F.col("name").alias("name"),
        F.when(F.col("type") == "folder",
               F.struct(F.lit(None).cast("int").alias("childCount"))).alias("folder"),
        F.when((F.col("type") == "file") & F.col("mime").isNotNull(),
               F.struct(F.col("mime").alias("mimeType"))).alias("file"),
        F.struct(F.col("pp").alias("path")).alias("parentReference"),
        F.col("dl").alias(DOWNLOAD_URL),
    )
    entries = (items.join(counts.select("parent_id", "n_pages"), "parent_id")
               .select("parent_id",
                       F.pmod(F.xxhash64("id"), F.col("n_pages")).alias("page_no"),
                       entry.alias("item")))
    grouped = entries.groupBy("parent_id", "page_no").agg(F.collect_list("item").alias("value"))
    page_nos = counts.select("parent_id", "n_pages",
                             F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_pages") - 1))
                             .alias("page_no"))

    def key(no):
        return F.concat(F.col("parent_id"), F.lit("-"), no.cast("string"))

    return (page_nos.join(grouped, ["parent_id", "page_no"], "left")
            .select(key(F.col("page_no")).alias("page_key"), "parent_id", "page_no",
                    F.to_json(F.struct(
                        F.coalesce("value", F.array().cast(T.ArrayType(ITEM_STRUCT))).alias("value"),
                        F.when(F.col("page_no") < F.col("n_pages") - 1,
                               key(F.col("page_no") + 1)).alias(NEXT_LINK),
                    )).alias("body")))


def _page_items(pages: DataFrame, body: str, schema: T.StructType) -> DataFrame:
    parsed = pages.select(F.from_json(F.col(body), schema).alias("p"))
    return parsed.select(F.explode(F.coalesce(F.col("p.value"),
                                              F.array().cast(schema["value"].dataType))).alias("it"))


def drive_list(pages: DataFrame, body: str = "body") -> DataFrame:
    """B1: ``id, name`` of every entry; a page without ``value`` is empty."""
    return _page_items(pages, body, DRIVE_PAGE_SCHEMA).select("it.id", "it.name")


def item_rows(pages: DataFrame, body: str = "body", keep: list[str] | None = None) -> DataFrame:
    """The 8 item columns of every entry of every page (plus the
    page columns named in ``keep``)."""
    keep = list(keep or [])
    parsed = pages.select(*keep, F.from_json(F.col(body), PAGE_SCHEMA).alias("p"))
    it = parsed.select(*keep, F.explode(F.coalesce(
        F.col("p.value"), F.array().cast(PAGE_SCHEMA["value"].dataType))).alias("it"))
    path = X.path_after_root(F.col("it.parentReference.path"))
    return it.select(
        *keep,
        F.col("it.id").alias("id"),
        F.col("it.name").alias("name"),
        F.when(F.col("it.folder").isNotNull(), "folder").otherwise("file").alias("type"),
        F.coalesce(F.col("it.file.mimeType"), F.lit("")).alias("mimeType"),
        F.coalesce(F.col(f"it.`{DOWNLOAD_URL}`"), F.lit("")).alias("uri"),
        path.alias("path"),
        X.full_path(path, F.col("it.name")).alias("fullpath"),
        F.col("it.name").alias("filename"),
    )


def parse_details(details: DataFrame, body: str = "body") -> DataFrame:
    return (details.select(F.from_json(F.col(body), DETAIL_SCHEMA).alias("d"))
            .select("d.id", "d.webUrl"))


def attach_web_urls(items: DataFrame, details: DataFrame) -> DataFrame:
    """Add ``url`` (webUrl, '' when absent) by one left join instead of
    one request per item."""
    d = details.select("id", "webUrl").dropDuplicates(["id"])
    return items.join(d, "id", "left").withColumn("url", F.coalesce("webUrl", F.lit(""))).drop("webUrl")


def item_listing(pages: DataFrame, details: DataFrame, body: str = "body") -> DataFrame:
    """B2: the 9-column listing: page entries plus their web URLs."""
    return attach_web_urls(item_rows(pages, body), parse_details(details, body))


def item_paths(items: DataFrame, parent_path: str = "pp") -> DataFrame:
    """B4 over an item table with a raw parent path column."""
    path = X.path_after_root(F.col(parent_path))
    return items.select("id", path.alias("path"), X.full_path(path, F.col("name")).alias("fullpath"))


# -------------------------------------------------------------- resolve ----

def resolve_folder_paths(items: DataFrame, requests: DataFrame, path: str = "path",
                         start_id: str = "root", salt_buckets: int = 0) -> DataFrame:
    """Resolve ``A/B/C`` folder paths to folder ids, segment by segment,
    folders only, case-sensitive; NULL when any segment is missing.

    Distinct paths are resolved once (a hot path costs one row), one left
    join per depth on ``(parent_id, name)``, checkpointed every few depths;
    requests get their id back by an equi-join on the path (AQE splits a
    skewed path key, or salt it with ``salt_buckets``)."""
    # Folders are read once per depth: materialise them once.
    folders = cut(items.where(F.col("type") == "folder")
                  .select(F.col("parent_id").alias("_parent"), F.col("name").alias("_name"),
                          F.col("id").alias("_fid")))
    paths = (requests.select(F.col(path).alias("_path")).where(F.col("_path").isNotNull()).distinct()
             .withColumn("_segs", F.split("_path", "/"))
             .withColumn("_depth", F.size("_segs"))
             .withColumn("_cur", F.lit(start_id)))
    paths = cut(paths)
    max_depth = paths.agg(F.max("_depth")).first()[0] or 0
    for d in range(max_depth):
        seg = F.get(F.col("_segs"), d)
        cond = ((F.col("_depth") > d) & (F.col("_parent") == F.col("_cur")) & (F.col("_name") == seg))
        paths = (paths.join(folders, cond, "left")
                 .withColumn("_cur", F.when(F.col("_depth") > d, F.col("_fid")).otherwise(F.col("_cur")))
                 .drop("_parent", "_name", "_fid"))
        if d % 4 == 3 or d == max_depth - 1:  # cut lineage every few depths and at the end
            paths = cut(paths)
    resolved = paths.select(F.col("_path"), F.col("_cur").alias("folder_id"))
    from tributary.functions.skew import salted_join
    return salted_join(requests, resolved, None, [(path, "_path")], salt_buckets, "left").drop("_path")


# ----------------------------------------------------------------- walk ----

def walk_tree(items: DataFrame, start, carry: list[str] | None = None, trace: list | None = None) -> DataFrame:
    """Every item under the start folder(s), with ``level`` (0 for the
    start folder's children) and ``walk_path`` (names from the start).

    ``start`` is a folder id or a DataFrame with an ``id`` column; the result has
    ``id, parent_id, name, type`` and the ``carry`` columns (default: all).
    Folders alone follow their parents by pointer doubling, which joins their
    names on the way: a round per doubling of the depth, not one a level.  Then each
    item meets its parent's path once.  Folders that no start leads to, also
    those in a circle of their own, are left out.  A start folder under a start
    (itself or another), or a folder that is there twice, raises CycleError."""
    base = ["id", "parent_id", "name", "type"]
    cols = base + [c for c in (items.columns if carry is None else carry) if c not in base]
    spark = items.sparkSession
    starts = spark.createDataFrame([(start,)], "id STRING") if isinstance(start, str) else start.select("id").where("id IS NOT NULL").distinct()
    starts = cut(starts.withColumnRenamed("id", "_sid"))
    folders = cut(items.where((F.col("type") == "folder") & F.col("id").isNotNull()).select(
        F.col("id").alias("node"), F.col("parent_id").alias("to"), F.lit(1).cast("long").alias("d"), F.col("name").alias("path")))
    known = folders.select(F.col("node").alias("_n")).distinct()
    pointers = (folders.join(known, F.col("to") == F.col("_n"), "left").join(starts, F.col("to") == F.col("_sid"), "left")
                .select("node", "to", "d", "path", (F.col("_n").isNull() | F.col("_sid").isNotNull()).alias("done")))
    ends = G.jump(pointers, trace, {"path": lambda own, above: F.concat(above, F.lit("/"), own)})
    reached, n = cut_counting(ends.join(starts, F.col("to") == F.col("_sid"), "left_semi").select("node", "d", "path"))
    inside = reached.join(starts, F.col("node") == F.col("_sid"), "left_semi")
    if n and (not inside.isEmpty() or reached.select("node").distinct().count() < n):
        raise CycleError("a folder of the item tree lies inside itself, or comes twice")
    parents = reached.select(F.col("node").alias("_pid"), F.col("d").cast("int").alias("level"), F.concat("path", F.lit("/")).alias("_prefix")).unionByName(
        starts.select(F.col("_sid").alias("_pid"), F.lit(0).alias("level"), F.lit("").alias("_prefix")))
    return cut(items.select(*cols).join(parents, F.col("parent_id") == F.col("_pid")).select(
        *cols, "level", F.concat("_prefix", "name").alias("walk_path")))


# ---------------------------------------------------------------- fetch ----

def fetch_by_id(items: DataFrame, requests: DataFrame, local_root: str,
                id_col: str = "file_id", salt_buckets: int = 0) -> DataFrame:
    """Per requested file id, the local folder (root + text after the
    first ``:/`` of the parent path), the target file and ``ok`` -- the id
    is a known file with a download URL.  ``salt_buckets`` spreads a hot id
    over that many join tasks (see ``functions.skew``)."""
    from tributary.functions.skew import salted_join
    it = items.select(F.col("id").alias("_iid"), F.col("name").alias("name"),
                      F.col("type").alias("_type"), F.col("pp").alias("_pp"), F.col("dl").alias("uri"))
    j = salted_join(requests, it, None, [(id_col, "_iid")], salt_buckets, "left")
    sub = X.subfolder(F.col("_pp"))
    folder = F.when(sub != "", F.concat(F.lit(local_root), F.lit("/"), sub)).otherwise(F.lit(local_root))
    return j.select(
        *requests.columns,
        F.col("name"),
        F.coalesce(sub, F.lit("")).alias("subfolder"),
        F.when(F.col("_iid").isNotNull(), F.concat(folder, F.lit("/"), F.col("name"))).alias("target_path"),
        (F.col("_iid").isNotNull() & (F.col("_type") == "file") & F.col("uri").isNotNull()).alias("ok"),
    )


def download_manifest(items: DataFrame, local_root: str, start_path: str = "root") -> DataFrame:
    """Every file under a start folder (``root`` or a folder path) with
    its local target ``normpath(root/path)/name`` and download URL."""
    spark = items.sparkSession
    if start_path == "root":
        start = "root"
    else:
        req = spark.createDataFrame([(start_path,)], "path STRING")
        start = resolve_folder_paths(items, req).select(F.col("folder_id").alias("id")).where("id IS NOT NULL")
    walked = walk_tree(items, start, carry=["pp", "dl"])
    files = walked.where(F.col("type") == "file")
    rel = F.regexp_replace(X.path_after_root(F.col("pp")), "^/+", "")  # leading slashes only
    folder = X.join_local(F.lit(local_root), rel)
    return files.select("id", "name",
                        F.concat(folder, F.lit("/"), F.col("name")).alias("target_path"),
                        F.coalesce(F.col("dl"), F.lit("")).alias("uri"))


def walk_remote(spark, get_page, start_ids: list[str], link_prefix: str = "",
                link_suffix: str = "",
                partitions: int | None = None):
    """B6 + B10 against the remote service itself: list the start folders
    page by page, then every sub-folder found, level by level.

    Each level is one distributed fetch (``pages.follow_pages`` over the
    level's folders, first link ``prefix + id + suffix``), parsed in the JVM
    and checkpointed; its folders become the next frontier.  Returns
    ``(items, errors)``: items carry ``parent_id`` (the folder listed) and
    ``level``; errors are the pages that could not be fetched."""
    from tributary.sources.pages import follow_pages

    frontier = spark.createDataFrame([(i,) for i in start_ids], "folder_id STRING")
    n_folders = len(start_ids)
    items_out, errors_out = [], []
    level, visited = 0, [frontier]
    while n_folders > 0:
        starts = frontier.select("folder_id", F.concat(F.lit(link_prefix), F.col("folder_id"),
                                                       F.lit(link_suffix)).alias("link"))
        pages = cut(follow_pages(starts, get_page, partitions=partitions))
        errors_out.append(pages.where(F.col("error").isNotNull()))
        rows, n_folders = cut_counting(
            item_rows(pages.where(F.col("error").isNull()), keep=["folder_id"])
            .withColumnRenamed("folder_id", "parent_id").withColumn("level", F.lit(level)),
            F.col("type") == "folder")
        items_out.append(rows)
        frontier = rows.where(F.col("type") == "folder").select(F.col("id").alias("folder_id"))
        if not frontier.join(union_all(visited, visited[0]), "folder_id", "left_semi").isEmpty():
            raise CycleError("a remote folder lies inside itself")
        visited.append(frontier)
        level += 1
    empty_items = item_rows(spark.createDataFrame([], "folder_id STRING, body STRING"),
                            keep=["folder_id"]).withColumnRenamed("folder_id", "parent_id") \
        .withColumn("level", F.lit(0))
    errors = union_all(errors_out, spark.createDataFrame([], "folder_id STRING, page_no LONG, "
                                                             "link STRING, body STRING, error STRING"))
    return union_all(items_out, empty_items), errors

"""Paged listings (op B10): follow ``@odata.nextLink`` until it is absent.

Input is a DataFrame of start links, one per folder.  Each task follows the
chains of its folders through an injected ``get_page(link) -> str`` and
emits raw page bodies; parsing is left to the JVM (``items.item_rows``).
A single folder's chain is serial by nature (page k+1 is only known from
page k), but folders spread over all tasks.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tributary.operators.items import NEXT_LINK

PAGE_ROW = T.StructType([
    T.StructField("folder_id", T.StringType()),
    T.StructField("page_no", T.LongType()),
    T.StructField("link", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("error", T.StringType()),
])


class FilePageStore:
    """``get_page`` over a folder of ``<link>.json`` files (local or any
    filesystem pyarrow can open).  Picklable, so executors can use it."""

    def __init__(self, root: str):
        self.root = root

    def __call__(self, link: str) -> str:
        from tributary.session import filesystem
        fs, base = filesystem(self.root)
        with fs.open_input_stream(f"{base}/{link}.json") as fh:
            return fh.read().decode("utf-8")


def _chain(get_page, folder, link, max_pages=None):
    """Pages of one folder: (folder, page_no, link, body, error) tuples.

    A next link seen before in the same chain is a loop in the service's
    answers: the chain ends with an error row instead of running forever.
    ``max_pages`` (off by default) is an optional guard that also ends with
    an error row, never silently."""
    n, seen = 0, set()
    while link:
        if link in seen:
            yield (folder, n, link, None, "next link repeats: the listing loops")
            return
        if max_pages is not None and n >= max_pages:
            yield (folder, n, link, None, f"more than {max_pages} pages")
            return
        seen.add(link)
        try:
            body = get_page(link)
            nxt = json.loads(body).get(NEXT_LINK)
            yield (folder, n, link, body, None)
        except Exception as e:
            yield (folder, n, link, None, f"{type(e).__name__}: {e}")
            return
        link, n = nxt, n + 1


def follow_pages(starts: DataFrame, get_page, folder_col: str = "folder_id",
                 link_col: str = "link", partitions: int | None = None,
                 max_pages: int | None = None, flush_pages: int = 256) -> DataFrame:
    """One row per fetched page.  A failed fetch ends that folder's chain
    with an ``error`` row; other folders continue."""

    def flush(rows):
        return pd.DataFrame(rows, columns=PAGE_ROW.fieldNames()).astype({"page_no": "int64"})

    def run(batches):
        # Stream pages out in small chunks: one folder may have millions of
        # pages, and they must never pile up in one worker's memory.
        for pdf in batches:
            rows = []
            for folder, link in zip(pdf[folder_col], pdf[link_col]):
                for page in _chain(get_page, folder, link, max_pages):
                    rows.append(page)
                    if len(rows) >= flush_pages:
                        yield flush(rows)
                        rows = []
            if rows:
                yield flush(rows)

    from tributary.operators.fetch import spread

    return spread(starts.select(folder_col, link_col), link_col, partitions).mapInPandas(run, PAGE_ROW)


# ------------------------------------------------------------------------
# The same listing as a Python data source:
#   spark.dataSource.register(PagedListingSource)
#   spark.read.format("paged_listing").option("store", dir)
#        .option("links", "F1=F1-0,F2=F2-0").load()
# One input partition per start link.  ``get_page`` may instead name an
# importable callable (``"package.module:function"``).  For very many
# folders prefer ``follow_pages`` over a DataFrame of start links.
# ------------------------------------------------------------------------

try:
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
except ImportError:  # pragma: no cover
    DataSource = None


def _resolve_getter(options: dict):
    if options.get("get_page"):
        import importlib
        mod, _, attr = options["get_page"].partition(":")
        return getattr(importlib.import_module(mod), attr)
    return FilePageStore(options["store"])


if DataSource is not None:

    class _LinkPartition(InputPartition):
        def __init__(self, folder: str, link: str):
            super().__init__((folder, link))
            self.folder, self.link = folder, link

    class _PagedListingReader(DataSourceReader):
        def __init__(self, options: dict):
            self.options = dict(options)

        def partitions(self):
            out = []
            for part in (self.options.get("links") or "").split(","):
                if part.strip():
                    folder, _, link = part.strip().partition("=")
                    out.append(_LinkPartition(folder, link or folder))
            return out

        def read(self, partition):
            get_page = _resolve_getter(self.options)
            max_pages = int(self.options["max_pages"]) if self.options.get("max_pages") else None
            yield from _chain(get_page, partition.folder, partition.link, max_pages)

    class PagedListingSource(DataSource):
        @classmethod
        def name(cls):
            return "paged_listing"

        def schema(self):
            return PAGE_ROW

        def reader(self, schema):
            return _PagedListingReader(self.options)

"""Best-fit packing of token sequences into fixed capacities.

Documents become token pieces in parallel; only how many pieces there are of
each length (at most ``capacity`` numbers) comes to the driver.  From those
counts a plan of bin kinds is made: pieces above a third of the capacity pair
at most twice in a bin by greedy matching (the largest with the largest that
still fits, which pairs as many as can be paired), then the smaller ones go,
largest first, into the tightest gap that holds them.  Bins of one kind are a
single entry with a count, so the plan's size is bounded by the capacity and
not by the corpus.  Each piece then finds its bin from its rank among the
pieces of its length.
"""

from __future__ import annotations

import bisect
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import written

#: White space of the tokenizer's patterns is Unicode White_Space; Python's
#: str.split() also splits at these.
NOT_SPACE = tuple("\x1c\x1d\x1e\x1f")
#: Stands between chunks that are encoded together.
MARK = "\0"
#: Marks that often follow a word.
MARKS = tuple(".,;:!?")
#: Chunks of text, and words, whose ids a worker remembers (two generations of these).
REMEMBERED, REMEMBERED_WORDS = 400_000, 600_000


class Memory:
    """A dict that forgets: two generations of at most ``limit`` entries."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def known(self, keys) -> tuple[dict[str, bytes], list[str]]:
        """What is remembered of the keys, and the keys that are not."""
        here, lost = {}, []
        for k in keys:
            if (v := self.young.get(k)) is None and (v := self.old.get(k)) is None:
                lost.append(k)
            else:
                here[k] = v
        return here, lost

    def keep(self, entries: dict[str, bytes]) -> None:
        if len(self.young) + len(entries) > self.limit:
            self.old, self.young = self.young, {}
        self.young.update((k, v) for k, v in entries.items() if len(k) <= 64)


class WordIds:
    """Ids of texts whose tokens never cross white space, remembered by chunk."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        spec = json.loads(open(path, encoding="utf-8").read()) | {"truncation": None, "padding": None}
        self.whole = Tokenizer.from_str(json.dumps(spec))
        self.plain = Tokenizer.from_str(json.dumps(spec | {"normalizer": None}))
        (self.mark,) = self.plain.encode(MARK, add_special_tokens=False).ids
        self.marks = {m: self.ids(self.plain, [m])[m] for m in (*MARKS, "")}
        self.chunk_ids, self.word_ids = Memory(REMEMBERED), Memory(REMEMBERED_WORDS)

    def ids(self, tokenizer, chunks: list[str]) -> dict[str, bytes]:
        """Many chunks go as one text with a separator of one known id between
        them; no token crosses the white space around it."""
        out = {}
        for i in range(0, len(chunks), 1024):
            part = chunks[i:i + 1024]
            ids = np.array(tokenizer.encode_batch_fast([f" {MARK} ".join([*part, ""])], add_special_tokens=False)[0].ids, dtype="<u4")
            flat, ends = ids.tobytes(), (4 * np.flatnonzero(ids == self.mark)).tolist()
            out.update(zip(part, (flat[a:b] for a, b in zip([0, *(e + 4 for e in ends)], ends))))
        return out

    def learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of new chunks.  A word, or a word and a mark, of letters below
        U+0250 is its lower-cased word (already composed, so the normalizer
        would leave it as it is) and the mark, if that is of letters, too;
        others go as they are."""
        out, split, other = {}, [], []
        for c in chunks:
            word, mark = (c[:-1], c[-1]) if c[-1:] in self.marks else (c, "")
            if word.isalpha() and max(word) < "\u0250" and word.lower().isalpha():
                split.append((c, word.lower(), mark))
            elif MARK in c:
                out[c] = np.array(self.whole.encode(c, add_special_tokens=False).ids, dtype="<u4").tobytes()
            else:
                other.append(c)
        out |= self.ids(self.whole, other)
        words, lost = self.word_ids.known({w for _, w, _ in split})
        words |= (new := self.ids(self.plain, lost))
        self.word_ids.keep(new)
        out.update((c, words[w] + self.marks[m]) for c, w, m in split)
        return out

    def packed(self, texts: list[str], chars: int = 1 << 22) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        i = 0
        while i < len(texts):
            j, total = i, 0
            while j < len(texts) and (j == i or total + len(texts[j]) <= chars):
                total += len(texts[j])
                j += 1
            lists = [[t] if any(c in t for c in NOT_SPACE) else t.split() for t in texts[i:j]]
            here, lost = self.chunk_ids.known({c for cs in lists for c in cs})
            here |= (new := self.learn(lost))
            self.chunk_ids.keep(new)
            for cs in lists:
                yield b"".join(map(here.__getitem__, cs))
            i = j


_LOADED: dict[str, WordIds] = {}


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int = 0) -> DataFrame:
    """Rows (doc_id, text) -> doc_id, piece, start, length, ids_crc32, and
    (part, nth): the task that made the piece and its place among that
    task's pieces of the same length.  A null text counts as empty."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        if path not in _LOADED:
            _LOADED[path] = WordIds(path)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows, cols = [], [[] for _ in range(5)]
            for k, ids in enumerate(_LOADED[path].packed([t or "" for t in batch.column(1).to_pylist()])):
                ids += end
                for p, start in enumerate(range(0, len(ids) // 4, capacity)):
                    cut = ids[4 * start:4 * (start + capacity)]
                    n = len(cut) // 4
                    rows.append(k)
                    for col, v in zip(cols, (p, start, n, zlib.crc32(cut), seen[n])):
                        col.append(v)
                    seen[n] += 1
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            made = [pa.array(c, k) for c, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *made, pa.array([part] * len(rows), pa.int32())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "nth", "part"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
                           T.StructField("nth", T.LongType()), T.StructField("part", T.IntegerType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Counts by length -> uses (length, first rank, ranks, first bin, per bin, offset):
    the pieces of that length with ranks from ``first rank`` on go to the bins
    from ``first bin`` on, ``per bin`` to each, side by side from ``offset``.

    Every kind of bin is touched at most log2(capacity) times (a placement
    leaves less than half of the gap), so there are at most
    O(capacity * log(capacity)) uses.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    taken = dict.fromkeys(left, 0)
    uses: list[tuple[int, int, int, int, int, int]] = []
    bins = 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> [(first bin, bins)]
    order: list[int] = []                        # the gaps there are, ascending

    def put(length: int, ranks: int, first: int, per_bin: int, offset: int) -> None:
        uses.append((length, taken[length], ranks, first, per_bin, offset))
        taken[length] += ranks
        left[length] -= ranks

    def gap(size: int, first: int, n: int) -> None:
        if size and n:
            if size not in gaps:
                gaps[size] = []
                bisect.insort(order, size)
            gaps[size].append((first, n))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        fits = bisect.bisect_right(large, capacity - a)
        b = large[fits - 1] if fits else 0
        n = left[a] // 2 if b == a else min(left[a], left[b]) if b else left[a]
        if b == a and n == 0:  # a last one of its length: the next smaller may join it
            b = large[fits - 2] if fits > 1 else 0
            n = min(1, left[b]) if b else 1
        put(a, n, bins, 1, 0)
        if b:
            put(b, n, bins, 1, a)
        gap(capacity - a - b, bins, n)
        bins += n
        large = [x for x in large if left[x]] if not left[a] or (b and not left[b]) else large

    for s in sorted((n for n in left if left[n]), reverse=True):
        while left[s]:
            at = bisect.bisect_left(order, s)
            if at == len(order):
                need = -(-left[s] // (capacity // s))
                gap(capacity, bins, need)
                bins += need
                continue
            size = order[at]
            first, n = gaps[size].pop()
            if not gaps[size]:
                del gaps[size], order[at]
            per = size // s
            full = min(n, left[s] // per)
            if full:
                put(s, full * per, first, per, capacity - size)
                gap(size - per * s, first, full)
            if full < n:
                rest = left[s]
                if rest:
                    put(s, rest, first + full, rest, capacity - size)
                    gap(size - rest * s, first + full, 1)
                gap(size, first + full + bool(rest), n - full - bool(rest))
    return uses


def pack(pieces_table: DataFrame, capacity: int) -> DataFrame:
    """Rows with (length, part, nth) -> the same plus sequence_id and offset."""
    per_part = written(pieces_table.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    uses = plan_bins(counts, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces_table.join(base, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    arr = np.array(sorted(uses), dtype=np.int64).reshape(-1, 6)
    bounds = {int(n): np.searchsorted(arr[:, 0], [n, n + 1]) for n in np.unique(arr[:, 0])}

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            use = np.empty(len(length), dtype=np.int64)
            for n in np.unique(length):
                low, high = bounds[int(n)]
                here = length == n
                use[here] = low + np.searchsorted(arr[low:high, 1], rank[here], side="right") - 1
            nth = rank - arr[use, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(arr[use, 3] + nth // arr[use, 4]), pa.array(arr[use, 5] + nth % arr[use, 4] * length)],
                [*batch.schema.names, "sequence_id", "offset"])

    schema = T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Per piece of each document: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    A document is its ids and ``end_id``; only longer ones than ``capacity``
    are cut.  Null text is empty (a piece of ``end_id`` alone); repeated rows
    are packed each; null doc_ids stay; other columns are ignored; an empty
    table gives no piece.
    """
    made = written(pieces(docs, path, capacity, end_id), "pieces")
    return pack(made, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

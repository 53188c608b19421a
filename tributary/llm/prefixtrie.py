"""Prefix trie of conversations as minimal-perfect-hash node tables (operator 12).

A node is a distinct sequence of first ``d`` turns; its digest chains its
parent's digest with its last turn.  Equal conversations are counted once, and the
weight of a node is the number of rows (prefixes of distinct conversations)
under it, known from one aggregation.  The shallowest nodes of at most
``BOUND`` rows are *cuts*: everything below a cut goes to one shard whole, many
cuts to a shard.  A shard enumerates its distinct digests, gives each a slot by a
minimal perfect hash (checked against the digest stored there), scatters counts
into flat numpy arrays and adds up leaves and tokens through the parent slots,
deepest first.  The few nodes above the cuts, too heavy for a task, add up their
cuts' sums along paths with Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import written

#: Rows below a cut at most, and rows of a shard about.
BOUND, SHARD = 1 << 15, 1 << 18
#: Ids of one node's ends that are joined into one string at most (by ranges of ids).
RANGE = 1 << 12
ROOT = hashlib.sha256(b"").digest()[:16]
PREFIXES = "conv_id long, depth int, digest binary, parent binary, words long, ends boolean"
NODES = ("conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "digest binary, parent binary, is_cut boolean")


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, turn digest, words) in the order of turn (null
    first, then role, then text); null role or text is empty; rows without
    a conv_id belong to no conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return turns.select(
        "conv_id", F.row_number().over(order).alias("place"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)).alias("turn_digest"),
        F.expr(r"size(regexp_extract_all(text, '[^ \\t-\\r]+', 0))").cast("long").alias("words"))


def grafted(turns: DataFrame, base: Column, heads: Column) -> DataFrame:
    """Every conversation with its first ``heads`` turns replaced by those of
    conversation ``base`` (both expressions of conv_id): (conv_id, part, place,
    turn_digest, words).  Part -1 is a row for each conversation, also those
    that are left without turns."""
    convs = turns.where("place = 1").select("conv_id", base.alias("base"), heads.alias("heads"))
    from_base = convs.join(turns.withColumnRenamed("conv_id", "base"), "base").where("place <= heads").select(
        "conv_id", F.lit(0).alias("part"), "place", "turn_digest", "words")
    own = turns.where(F.col("place") > heads).select("conv_id", F.lit(1).alias("part"), "place", "turn_digest", "words")
    start = convs.select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("place"), F.lit(None).cast("binary").alias("turn_digest"), F.lit(0).cast("long").alias("words"))
    return start.unionByName(from_base).unionByName(own)


def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place, its part -1 first -> a row per
    prefix.  Only the last prefix is held back, to mark it as an end."""
    held = None
    for batch in batches:
        out = []
        for conv, part, turn, words in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "turn_digest", "words"))):
            if held:
                out.append((*held, part < 0))
            if part < 0:
                held = (conv, 0, ROOT, None, 0)
            else:
                held = (conv, held[1] + 1, hashlib.sha256(held[2] + turn).digest()[:16], held[2], words)
        if out:
            yield _rows(out)
    if held:
        yield _rows([(*held, True)])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["conv_id", "depth", "digest", "parent", "words", "ends"])


class SlotTable:
    """Minimal perfect hash of distinct 16-byte digests, as an (n, 2) uint64
    array: each level is a bit array in which a key that is alone at its place stays
    and the others go on; a key's slot is the rank of its bit.  ``stored`` holds each
    slot's digest, so that a key from outside is told apart."""

    def __init__(self, keys: np.ndarray):
        self.levels, self.before, left, before = [], [], keys, 0
        while len(left):
            size = max(1, 2 * len(left))
            at = self._places(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append(alone)
            self.before.append(before + np.cumsum(alone) - alone)
            before += int(alone.sum())
            left = left[~alone[at]]
        self.stored = np.zeros_like(keys)
        self.stored[self._slots(keys)] = keys

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = keys[:, 0] ^ (keys[:, 1] * np.uint64(2 * level + 1)) ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(keys), -1), np.arange(len(keys))
        for level, (alone, before) in enumerate(zip(self.levels, self.before)):
            at = self._places(keys[open_], level, len(alone))
            hit = alone[at]
            out[open_[hit]] = before[at[hit]]
            open_ = open_[~hit]
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for those that the table does not hold."""
        out = self._slots(keys)
        if len(self.stored):
            out[(self.stored[out] != keys).any(axis=1)] = -1
        return out


def _keys(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2)


def shard_nodes(rows: pa.Table) -> pa.Table:
    """The nodes of a shard's subtrees from its prefixes of distinct
    conversations (digest, parent, depth, words, conv_id, n_convs)."""
    digests, parents = _keys(rows.column("digest")), _keys(rows.column("parent"))
    distinct, first = np.unique(digests, axis=0, return_index=True)
    table = SlotTable(distinct)
    slot, n = table.slots(digests), len(distinct)
    own = table.slots(distinct)
    of = np.empty(n, np.int64)
    of[own] = first  # a row of each slot's node
    columns = {c: rows.column(c).to_numpy() for c in ("depth", "words", "conv_id", "n_convs")}
    convs, low = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
    np.add.at(convs, slot, columns["n_convs"])
    np.minimum.at(low, slot, columns["conv_id"])
    depth, parent = columns["depth"][of], table.slots(parents[of])
    saved = (convs - 1) * columns["words"][of]
    children, leaves = np.zeros(n, np.int64), np.zeros(n, np.int64)
    inner = parent >= 0
    np.add.at(children, parent[inner], 1)
    leaves[children == 0] = 1
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    parent_conv = pa.array(np.where(inner, low[np.maximum(parent, 0)], 0), mask=~inner)
    at = pa.array(of)
    return pa.table([pa.array(low), pa.array(depth, pa.int32()), parent_conv, pa.array(convs), pa.array(children), pa.array(leaves), pa.array(saved),
                     rows.column("digest").take(at), rows.column("parent").take(at), pa.array(~inner)],
                    names=["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "digest", "parent", "is_cut"])


def ends_digests(prefixes: DataFrame) -> DataFrame:
    """(digest, ends_sha256): ids are joined by ranges of ids first, then a task
    reads a node's ranges in order and never holds more than one."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    ranges = prefixes.where("ends").groupBy("digest", F.floor(F.col("conv_id") / RANGE).alias("range")).agg(ids.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            out = []
            for digest, ids in zip(batch.column("digest").to_pylist(), batch.column("ids").to_pylist()):
                if digest != now:
                    if now is not None:
                        out.append((now, sha.hexdigest()))
                    now, sha = digest, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["digest", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([sha.hexdigest()])], ["digest", "ends_sha256"])

    return ranges.repartition("digest").sortWithinPartitions("digest", "range").select("digest", "ids").mapInArrow(run, "digest binary, ends_sha256 string")


def trie_nodes(turns: DataFrame, bound: int = BOUND, shard: int = SHARD) -> DataFrame:
    """All nodes of the trie of ``grafted`` turns: conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Repeated turns count each; a conversation's turns are read in order by one
    task, one at a time; no conversations give no node, conversations without turns
    the root alone.
    """
    spark = turns.sparkSession
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    prefixes = written(ordered.mapInArrow(chain, PREFIXES), "trie-prefixes")

    # distinct conversations, by their smallest id
    whole = prefixes.where("ends").groupBy("digest").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("depth").alias("length")).drop("digest")
    paths = written(prefixes.drop("ends").join(whole, "conv_id"), "trie-paths")
    weights = paths.groupBy("digest").agg(F.sum(F.col("length") - F.col("depth") + 1).alias("weight"))
    heavy = written(weights.where((F.col("weight") > bound) | (F.col("digest") == F.lit(ROOT))), "trie-heavy")
    marked = written(paths.join(heavy.select("digest", F.lit(True).alias("heavy")), "digest", "left"), "trie-marked")

    # below the cuts: shards of whole subtrees
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), paths.count() // shard + 1)
    light = marked.where("heavy IS NULL")
    cuts = light.groupBy("conv_id").agg(F.min_by("digest", "depth").alias("cut"))
    dealt = light.join(cuts, "conv_id").withColumn("shard", F.pmod(F.xxhash64("cut"), F.lit(shards)))
    below = written(dealt.select("shard", "digest", "parent", "depth", "words", "conv_id", "n_convs").groupBy("shard").applyInArrow(shard_nodes, NODES), "trie-below")

    # above them: sums along the paths of the smallest members
    tops = marked.where("heavy")
    of = tops.groupBy("digest").agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent", True).alias("parent"),
                                    F.sum("n_convs").alias("n_convs"), F.max("words").alias("words"))
    of = written(of, "trie-above")
    units = below.where("is_cut").select("conv_id", "depth", "n_leaves", "saved_tokens").unionByName(
        of.select("conv_id", "depth", F.lit(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")))
    along = tops.select("conv_id", "depth", "digest", F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens")).unionByName(
        units.withColumn("digest", F.lit(None).cast("binary")))
    deeper = Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
    sums = (along.select("digest", *(F.sum(c).over(deeper).alias(c) for c in ("n_leaves", "saved_tokens"))).where("digest IS NOT NULL")
            .groupBy("digest").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    children = below.where("is_cut").select("parent").unionByName(of.select("parent")).where("parent IS NOT NULL").groupBy("parent").agg(
        F.count(F.lit(1)).alias("n_children")).withColumnRenamed("parent", "digest")
    names = of.select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "digest"]
    no_children = F.coalesce("n_children", F.lit(0))
    upper = (of.join(children, "digest", "left").join(sums, "digest").join(names, "parent", "left")
             .withColumn("n_leaves", F.when(no_children == 0, 1).otherwise(F.col("n_leaves"))).withColumn("n_children", no_children).select(*shown))
    lower = below.where("NOT is_cut").select(*shown).unionByName(
        below.where("is_cut").drop("parent_conv_id").join(names, "parent", "left").select(*shown))
    return lower.unionByName(upper).join(ends_digests(prefixes), "digest", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))

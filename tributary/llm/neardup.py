"""MinHash near-duplicates by a chosen-path set similarity join.

Documents are sets of word shingles.  Equal sets fall into one class first.  A
tree deals the classes by the MinHash value of a chosen token; a node that is
too large is branched again by one or two chosen tokens of the sketch (1 /
similarity on average, so that similar pairs survive at any depth), a small one
-- or one whose members mostly resemble each other -- is compared exhaustively on
sketches.  Independent trees repeat this until a pair is missed with a
probability of less than one in 10^5.

A compared node hands on a maximum spanning forest of its candidate pairs, not
all of them.  These are confirmed on the full sets; then the nodes are compared
again, and where members may have links with others that they are not yet linked
with, their full sets are compared within the node, which hands on links alone.
So no link between components is lost and no group emits all of its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import SALTS, with_group_min, written
from tributary.llm.components import connected_components

TREES, SKETCH = 10, 128
#: Nodes up to LEAF are compared as they are, larger ones branched -- in a task
#: up to GATHERED, by Spark beyond.  From LEVELS on, nodes beyond that which
#: still don't shrink are dealt out in parts that meet through their pivots; members
#: that were not linked with most of such a node meet all its parts in the end.
LEAF, GATHERED, LEVELS = 64, 4096, 12
#: Estimates from SKETCH values may be so far below the similarity (3.8 sigma).
SLACK = 0.12
#: A node is compared exhaustively where members agree with so much of it on average.
DENSE = 0.4

_RNG = np.random.default_rng(20240101)
_MIX = _RNG.integers(1, 2**63, 6, dtype=np.uint64) | np.uint64(1)
_A = _RNG.integers(1, 2**63, SKETCH, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 2**63, SKETCH, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * _MIX[4]
    x = (x ^ (x >> np.uint64(29))) * _MIX[5]
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, words: int = 3) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``words`` words
    (A-Z lower-cased; words end at ASCII white space).  A shorter text
    is one shingle; one without words has none."""
    import xxhash

    parts = (text or "").encode("utf-8", errors="surrogatepass").lower().split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), dtype=np.uint64, count=len(parts))
    k = min(words, len(h))
    total = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        total = mixed(total * _MIX[0] + h[i:len(h) - k + 1 + i])
    return np.unique(total)


def minhash(s: np.ndarray, step: int = 4096) -> np.ndarray:
    """SKETCH smallest 32-bit values of a non-empty set under as many hash functions."""
    low = np.full(SKETCH, 2**32 - 1, dtype=np.uint64)
    for i in range(0, len(s), step):
        v = s[i:i + step, None] * _A
        v += _B
        v >>= np.uint64(32)
        np.minimum(low, v.min(axis=0), out=low)
    return low


def class_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, cid (equal for equal sets; null for empty ones),
    sketch (a byte of each MinHash value), tokens (the trees' first ones)."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n, cid, sketch, tokens = [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, words)
                n.append(len(s))
                if not len(s):
                    cid.append(None), sketch.append(None), tokens.append(None)
                    continue
                low = minhash(s)
                cid.append(class_id(s))
                sketch.append(low.astype(np.uint8).tobytes())
                tokens.append(mixed(low[:TREES] * np.uint64(64) + np.arange(TREES, dtype=np.uint64)).astype(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(cid, pa.int64()), pa.array(sketch, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "cid", "sketch", "tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, cid long, sketch binary, tokens array<long>")


# -- nodes of a tree, in a task ---------------------------------------------


def chosen(node: int, similarity: float) -> list[int]:
    """The one or two coordinates a node branches by: 1 / similarity on average."""
    u = hashlib.blake2b(node.to_bytes(8, "little", signed=True), digest_size=8).digest()
    first = u[0] * 256 + u[1]
    second = (u[4] * 256 + u[5]) / 65536 < 1 / similarity - 1
    return [first % SKETCH] + ([(first + 1 + u[2] % (SKETCH - 1)) % SKETCH] if second else [])


def child(node: int, coordinate: int, token: int) -> int:
    raw = node.to_bytes(8, "little", signed=True) + bytes([coordinate]) + int(token).to_bytes(8, "little", signed=True)
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def forest(s: np.ndarray, least: float) -> list[tuple[int, int]]:
    """A maximum spanning forest (Prim's) of the pairs that agree on at least
    ``least`` of their sketch; every pair is compared once, one row at a time."""
    n, out = len(s), []
    best, link = np.full(n, -1.0), np.zeros(n, dtype=np.int64)
    todo = np.ones(n, dtype=bool)
    now = 0
    for _ in range(n - 1):
        todo[now] = False
        agree = (s[todo] == s[now]).mean(axis=1)
        rest = np.flatnonzero(todo)
        better = rest[agree > best[rest]]
        best[better], link[better] = agree[agree > best[rest]], now
        now = int(rest[best[rest].argmax()])
        if best[now] >= least:
            out.append((int(link[now]), now))
        else:
            best[now] = -1.0  # the next tree starts here
    return out


def across(s: np.ndarray, labels: np.ndarray, least: float) -> np.ndarray:
    """Members that agree on at least ``least`` with one of another label."""
    open_ = np.zeros(len(s), dtype=bool)
    values, counts = np.unique(labels, return_counts=True)
    for i in np.flatnonzero(labels != values[counts.argmax()]):
        near = (labels != labels[i]) & ((s == s[i]).mean(axis=1) >= least)
        if near.any():
            open_[i] = True
            open_ |= near
    return np.flatnonzero(open_)


def links_across(sets: list[np.ndarray], labels: np.ndarray, asks: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """On full sets, links (row numbers) of those that ask with others that
    do not yet have their label: as few as join all that belong together."""
    sizes = np.array([len(x) for x in sets])
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.cumsum(sizes) - sizes
    labels, mark = labels.copy(), np.zeros(int(flat.max()) + 1, dtype=np.int64)
    for i in np.flatnonzero(asks):
        own = flat[starts[i]:starts[i] + sizes[i]]
        mark[own] = 1
        both = np.add.reduceat(mark[flat], starts)
        mark[own] = 0
        near = 100 * both >= percent * (sizes[i] + sizes - both)
        while (left := np.flatnonzero(near & (labels != labels[i]))).size:
            yield int(i), int(left[0])
            labels[labels == labels[left[0]]] = labels[i]


def compare(node: int, s: np.ndarray, labels: np.ndarray | None, similarity: float) -> Iterator[tuple[int, int]]:
    """Candidate pairs (row numbers) of a node: branched while it is large and
    its members differ, else compared exhaustively.  With labels: (row, row)
    of each member that may have a link to one of another label."""
    todo = [(node, np.arange(len(s)))]
    while todo:
        node, rows = todo.pop()
        part = s[rows]
        if labels is not None and (labels[rows] == labels[rows[0]]).all():
            continue
        if len(rows) > LEAF:
            seen = part[:, chosen(node ^ 1, 1.0)[0]::8]  # 16 coordinates or fewer
            share = np.mean([np.bincount(c, minlength=256)[c] for c in seen.T], axis=0) / len(rows)
            if share.max() < DENSE:
                for c in chosen(node, similarity):
                    order = np.argsort(part[:, c], kind="stable")
                    tokens, starts = np.unique(part[order, c], return_index=True)
                    for token, group in zip(tokens, np.split(order, starts[1:])):
                        if len(group) > 1:
                            todo.append((child(node, c, token), rows[group]))
                continue
        if labels is None:
            yield from ((int(rows[a]), int(rows[b])) for a, b in forest(part, similarity - SLACK))
        else:
            yield from ((int(r), int(r)) for r in rows[across(part, labels[rows], similarity - SLACK)])


def rest_and_all(dense: DataFrame, labels: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """(at, cid, label, asks): members of a dealt-out node that do not have its
    most frequent label (they ask) and all that may have a link with one.  Both are
    dealt into parts of about GATHERED, and each part of the one meets each of
    the other at a place of its own."""
    members = written(dense.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid")).join(
        classes.select("cid", "sketch"), "cid").select("node", "cid", "label", "sketch"), "dense-nodes")
    of_label = members.groupBy("node", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = of_label.groupBy("node").agg(F.max_by("label", "n").alias("most"), F.sum("n").alias("n"), F.max("n").alias("of_most")).where(F.col("n") > F.col("of_most"))
    sizes = sizes.select("node", "most", F.ceil(F.col("n") / GATHERED).cast("int").alias("parts"), F.ceil((F.col("n") - F.col("of_most")) / GATHERED).cast("int").alias("blocks"))
    known = members.join(sizes, "node")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    rest = known.where(F.col("label") != F.col("most")).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")).withColumn("part", every("parts"))
    whole = known.withColumn("part", F.pmod(F.xxhash64("cid", "node"), F.col("parts")).cast("int")).withColumn("block", every("blocks"))
    rows = rest.withColumn("asks", F.lit(1)).unionByName(whole.withColumn("asks", F.lit(0))).select(
        F.xxhash64("node", "part", "block").alias("at"), "asks", "cid", "label", "sketch")

    def run(batches):
        import pyarrow as pa

        def met(group):
            ask, one = [r for r in group if r[1]], [r for r in group if not r[1]]
            if not ask or not one:
                return
            labels = np.array([r[3] for r in one], dtype=np.int64)
            s = np.frombuffer(b"".join(r[4] for r in one), dtype=np.uint8).reshape(len(one), SKETCH)
            open_, out = np.zeros(len(one), dtype=bool), []
            for r in ask:
                near = (labels != r[3]) & ((s == np.frombuffer(r[4], dtype=np.uint8)).mean(axis=1) >= similarity - SLACK)
                if near.any():
                    open_ |= near
                    out.append(r)
            out += [one[i] for i in np.flatnonzero(open_)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in (0, 2, 3, 1)], ["at", "cid", "label", "asks"])

        group: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and group[0][0] != row[0]:
                    yield from met(group)
                    group = []
                group.append(row)
        yield from met(group)

    return rows.repartition("at").sortWithinPartitions("at").mapInArrow(run, "at long, cid long, label long, asks long")


def compared(nodes: DataFrame, similarity: float) -> DataFrame:
    """(node, cid, sketch) -> distinct candidate pairs (a, b), a < b.  Nodes
    have at most GATHERED members.

    With ``label``: (at, cid, label, asks), the members of a node that may have
    links across labels; all but those of the most frequent label ask.
    """
    labelled = "label" in nodes.columns

    def run(batches):
        import pyarrow as pa

        def found(node, members):
            cids = np.array([m[0] for m in members], dtype=np.int64)
            s = np.frombuffer(b"".join(m[1] for m in members), dtype=np.uint8).reshape(len(members), SKETCH)
            if not labelled:
                return {(int(min(cids[i], cids[j])), int(max(cids[i], cids[j]))) for i, j in compare(node, s, None, similarity) if cids[i] != cids[j]}
            labels = np.array([m[2] for m in members], dtype=np.int64)
            open_ = sorted({i for i, _ in compare(node, s, labels, similarity)})
            if not open_:
                return set()
            values, counts = np.unique(labels[open_], return_counts=True)
            most = values[counts.argmax()]
            return {(node, int(cids[i]), int(labels[i]), int(labels[i] != most)) for i in open_}

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["at", "cid", "label", "asks"] if labelled else ["a", "b"])

        now, members, out = None, [], set()
        for batch in batches:
            for node, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if node != now:
                    if len(members) > 1:
                        out |= found(now, members)
                    now, members = node, []
                    if len(out) > 10_000:
                        yield batch_of(out)
                        out = set()
                members.append(rest)
        if len(members) > 1:
            out |= found(now, members)
        if out:
            yield batch_of(out)

    columns = ["node", "cid", "sketch", *(["label"] if labelled else [])]
    dealt = nodes.select(*columns).repartition("node").sortWithinPartitions("node")
    return dealt.mapInArrow(run, "at long, cid long, label long, asks long") if labelled else dealt.mapInArrow(run, "a long, b long").distinct()


# -- trees -------------------------------------------------------------------


def join_back(rows: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """rows left join values (one row a key) on a key that may be hot: rows
    and copies of the value are dealt by (key, salt), as many as exist."""
    dealt = rows.withColumn("_salt", (F.rand(11) * SALTS).cast("int")) if "doc_id" not in rows.columns else rows.withColumn(
        "_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    copies = dealt.where(F.col(key).isNotNull()).select(key, "_salt").distinct().join(values, key)
    return dealt.join(copies, [key, "_salt"], "left").drop("_salt")


def tree_nodes(classes: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(node, cid, sketch) of all nodes that a task may gather; the pairs
    (a, b) of members of larger nodes with their node's pivot; (node, cid) of
    the large nodes that were dealt out in parts."""
    level = classes.select("cid", F.explode("tokens").alias("node"))
    ready, stars, dense, depth = None, None, None, 0
    while True:
        level = written(level.distinct() if depth else level, "tree-level")
        sizes = level.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("pivot")).where(F.col("n") > 1)
        small = level.join(sizes.where(F.col("n") <= GATHERED).select("node"), "node")
        ready = small if ready is None else ready.unionByName(small)
        large = sizes.where(F.col("n") > GATHERED)
        if large.isEmpty():
            break
        depth += 1
        big = written(level.join(F.broadcast(large) if large.count() <= 1000 else large, "node"), "large-nodes")
        star = big.where(F.col("cid") != F.col("pivot")).select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b"))
        stars = star if stars is None else stars.unionByName(star)
        if depth > LEVELS:
            if dense is None:
                dense = big.select("node", "cid")
            level = big.select("cid", F.xxhash64("node", F.pmod(F.xxhash64("cid", "node"), F.ceil(2 * F.col("n") / GATHERED))).alias("node"))
            continue

        def branch(batches):
            import pyarrow as pa

            for batch in batches:
                cids, nodes = [], []
                for cid, node, sketch in zip(*(c.to_pylist() for c in batch.columns)):
                    for c in chosen(node, similarity):
                        cids.append(cid)
                        nodes.append(child(node, c, sketch[c]))
                yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(nodes, pa.int64())], ["cid", "node"])

        level = big.join(classes.select("cid", "sketch"), "cid").select("cid", "node", "sketch").mapInArrow(branch, "cid long, node long")
    return ready.join(classes.select("cid", "sketch"), "cid").select("node", "cid", "sketch"), stars, dense


def full_sets(wanted: DataFrame, classes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(cid, items): the full sets of the wanted cids, made again from the
    texts of the classes' first documents."""
    needed = classes.join(wanted.select("cid").distinct(), "cid", "left_semi").select("doc_id").distinct()

    def sets(batches):
        import pyarrow as pa

        for batch in batches:
            made = [shingle_set(t, words) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([class_id(s) for s in made], pa.int64()), pa.array([s.tobytes() for s in made], pa.binary())], ["cid", "items"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(needed, "doc_id", "left_semi").select("text")
    return written(texts.mapInArrow(sets, "cid long, items binary"), "full-sets")


def confirmed_across(members: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(at, cid, label, asks) -> links (a, b) across labels, on full sets: what
    meets at one place is compared there, and only links leave it."""
    members = written(members, "members-across")
    full = full_sets(members, classes, docs, words)

    def run(batches):
        import pyarrow as pa

        def found(group):
            rows = list({r[2]: r for r in group}.values())
            cids, labels = (np.array([r[c] for r in rows], dtype=np.int64) for c in (2, 3))
            out = [(int(min(cids[i], cids[j])), int(max(cids[i], cids[j]))) for i, j in links_across(
                [np.frombuffer(r[4], dtype=np.uint64) for r in rows], labels, np.array([r[1] > 0 for r in rows]), percent)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

        group: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and group[0][0] != row[0]:
                    yield from found(group)
                    group = []
                group.append(row)
        if group:
            yield from found(group)

    rows = members.join(full, "cid").select("at", "asks", "cid", "label", "items")
    return rows.repartition("at").sortWithinPartitions("at", "asks").mapInArrow(run, "a long, b long").distinct()


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those pairs (a, b) of class ids with 100 |A & B| >= percent |A u B| on full sets."""
    full = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("cid")), classes, docs, words)

    def linked(batches):
        import pyarrow as pa

        for batch in batches:
            a, b = ([np.frombuffer(x, dtype=np.uint64) for x in batch.column(i).to_pylist()] for i in (2, 3))
            keep = []
            for x, y in zip(a, b):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = pairs.join(full.select(F.col("cid").alias("a"), F.col("items").alias("items_a")), "a")
    both = left.join(full.select(F.col("cid").alias("b"), F.col("items").alias("items_b")), "b")
    return both.select("a", "b", "items_a", "items_b").mapInArrow(linked, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of docs (doc_id, text).

    Null, empty and blank texts have no shingle and link with nothing.  A row
    without doc_id takes part; its component is the smallest doc_id there is,
    null if there is none, in which case it is kept.  Rows that repeat a doc_id are rows of their own;
    other columns are ignored; an empty table gives no row.
    """
    similarity = percent / 100
    made = written(sketches(docs, words), "sketches")
    # one row a class; equal sets are combined before the shuffle
    classes = written(made.where(F.col("cid").isNotNull()).groupBy("cid").agg(
        F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch"), F.first("tokens").alias("tokens")), "classes")
    nodes, stars, dense = tree_nodes(classes, similarity)
    nodes = written(nodes, "nodes")
    first = compared(nodes, similarity)
    first = written(first if stars is None else first.unionByName(stars).distinct(), "pairs")
    links = written(confirmed(first, classes, docs, words, percent), "links")
    labels = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), "linked").withColumnsRenamed({"node": "cid", "component": "label"})
    marked = nodes.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    mixed_nodes = marked.groupBy("node").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("node")
    members = compared(marked.join(mixed_nodes, "node", "left_semi"), similarity)
    if dense is not None:
        members = members.unionByName(rest_and_all(dense, labels, classes, similarity))
    more = confirmed_across(members, classes, docs, words, percent)
    ids = classes.select("cid", "doc_id")
    edges = links.unionByName(more).join(ids.select(F.col("cid").alias("a"), F.col("doc_id").alias("u")), "a").join(
        ids.select(F.col("cid").alias("b"), F.col("doc_id").alias("v")), "b").select("u", "v")
    comps = connected_components(edges, "near-duplicates")
    by_class = ids.join(comps, F.col("doc_id") == F.col("node"), "left").select("cid", F.coalesce("component", "doc_id").alias("component_id"))
    rows = join_back(made.select("doc_id", "n_shingles", "cid"), "cid", by_class)
    rows = rows.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))

"""Approximate nearest neighbours by inner product with NN-descent.

Equal vectors are one node.  A first neighbour list for each node comes from
random-hyperplane leaves that are compared exhaustively; NN-descent then improves
the lists in rounds of Spark joins, until hardly any neighbour is new: all neighbours of a
node meet there, but for those that have met before, and keep the best they have seen.  Queries search the finished
graph greedily: a beam of the best nodes so far, of which those not yet visited
are visited in the next round -- again a join -- until none is left.

A visited node's row holds its neighbours' vectors, in eight bits a component of
what they differ by from the nearest vector of a small codebook, so a visit reads
one row; the beam's best are scored again in double precision on the original
vectors.  Lengths that differ are evened out by one more component
of the stored vectors, so that the largest inner product is the nearest node.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tributary.llm.common import written
from tributary.llm.neardup import join_back
from tributary.llm.topk import usable

#: Neighbours that a node keeps, and how many it is also known by; leaves' size
#: and how often nodes are dealt into leaves.
NEIGHBOURS, KNOWN_BY, LEAF, DEALS = 32, 16, 2048, 4
#: Rounds of NN-descent end when no more than this share of all neighbours is new.
CHANGED = 0.001
#: Below this share of new neighbours, nodes without a new one are sorted out before vectors are fetched.
QUIET = 0.05
#: Rows that a worker takes at once.
ROWS = 1 << 15
#: Nodes of a block that meets who is shown at their node.
BLOCK = 32
#: Size of the random groups that fill up first lists.
CHANCE = 256
#: Nodes in a beam, and those of them that are scored exactly.
BEAM, RESCORED = 200, 100
#: Vectors that the hyperplanes' medians and the codebook are taken of, and the codebook's size.
SAMPLE, BOOK = 4000, 256


def best(ids: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best distinct ids; ties go to the smaller id."""
    ids, first = np.unique(ids, return_index=True)
    sims = sims[first]
    keep = np.argsort(-sims, kind="stable")[:k]
    return ids[keep], sims[keep]


def streams(batches, key: int = 0) -> Iterator[list[tuple]]:
    """Groups of consecutive rows with the same key, across batches."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and rows[0][key] != row[key]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def grouped(df: DataFrame, fn, schema: str, *order: str) -> DataFrame:
    """``fn`` on the rows (tuples) of each value of the first column; it
    yields output rows.  ``order`` sorts a group's rows."""
    def run(batches):
        import pyarrow as pa

        kinds = {"long": pa.int64(), "binary": pa.binary(), "int": pa.int32()}
        names, types = zip(*((f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")))
        out: list[tuple] = []
        for rows in streams(batches):
            out.extend(fn(rows))
            if len(out) >= 500:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], list(names))
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], list(names))

    key = df.columns[0]
    return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def whole(batches, rows: int = ROWS):
    """Tables of about so many consecutive rows, sorted by the first column, whose
    values are never split between two of them."""
    import pyarrow as pa

    held, n = [], 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        n += len(batch)
        last = batch.column(0)[-1].as_py()
        if n < rows or held[0].column(0)[0].as_py() == last:
            continue
        table = pa.Table.from_batches(held)
        cut = int(np.searchsorted(table.column(0).to_numpy(), last))
        yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        n = sum(map(len, held))
    if held:
        yield pa.Table.from_batches(held)


def arrays(table) -> list[np.ndarray]:
    """Columns as arrays; values of binary ones, all of one length, as rows of bytes."""
    import pyarrow as pa

    return [np.frombuffer(b"".join(c.to_pylist()), dtype=np.int8).reshape(len(c), -1) if pa.types.is_binary(c.type) else c.to_numpy() for c in table.columns]


def firsts(*keys: np.ndarray) -> np.ndarray:
    """Whether a row of sorted keys differs from the one before it."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def packed(vectors: DataFrame, longest: float | None) -> DataFrame:
    """(node, embedding) -> (node, vec): floats and one more component, which
    evens the length out to ``longest`` (squared) or, without it, is 0."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), dtype=np.float64)
            even = np.zeros(len(x)) if longest is None else np.sqrt(np.maximum(0, longest - (x * x).sum(axis=1)))
            flat = np.concatenate([x, even[:, None]], axis=1).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in flat], pa.binary())], ["node", "vec"])

    return vectors.select("node", "embedding").mapInArrow(run, "node long, vec binary")


def sampled(nodes: DataFrame) -> np.ndarray:
    """The vectors with the smallest hashes, at most SAMPLE."""
    rows = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("vec").collect()
    return np.array([np.frombuffer(r["vec"], dtype=np.float32) for r in rows])


def codebook(sample: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Up to BOOK centers of the sample (k-means)."""
    book = sample[:BOOK].copy()
    for _ in range(rounds):
        own = nearest(sample, book)
        for c in np.unique(own):
            book[c] = sample[own == c].mean(axis=0)
    return book


def nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book * book).sum(axis=1) - 2 * (x @ book.T)).argmin(axis=1)


def first_lists(nodes: DataFrame, count: int, sample: np.ndarray) -> DataFrame:
    """(node, vec) -> (node, ids, sims): the best of all leaves a node was in."""
    depth = max(0, int(np.ceil(np.log2(max(1, count) / (LEAF / 2)))))
    planes = np.random.default_rng(5).normal(size=(DEALS, depth, sample.shape[1])).astype(np.float32)
    medians = np.median(sample @ planes.reshape(-1, sample.shape[1]).T, axis=0).reshape(DEALS, depth) if depth else np.zeros((DEALS, 0))

    def deal(batches):
        import pyarrow as pa

        for batch in batches:
            raw = batch.column(1).to_pylist()
            x = np.frombuffer(b"".join(raw), dtype=np.float32).reshape(len(raw), -1)
            for d in range(DEALS):
                bits = (x @ planes[d].T) > medians[d]
                leaf = bits @ (1 << np.arange(depth, dtype=np.int64)) if depth else np.zeros(len(x), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(leaf * DEALS + d, pa.int64()), *batch.columns], ["leaf", "node", "vec"])
            # one more deal at random: nobody's list is short, no group is cut off
            chance = (batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(-1 - chance % max(1, count // CHANCE), pa.int64()), *batch.columns], ["leaf", "node", "vec"])

    def compare(rows):
        ids = np.array([r[1] for r in rows], dtype=np.int64)
        x = np.frombuffer(b"".join(r[2] for r in rows), dtype=np.float32).reshape(len(rows), -1)
        s = x @ x.T
        np.fill_diagonal(s, -np.inf)
        k = min(NEIGHBOURS, len(rows) - 1)
        if k:
            near = np.argpartition(-s, k - 1, axis=1)[:, :k]
            for i, j in enumerate(near):
                yield int(ids[i]), ids[j].tobytes(), s[i, j].tobytes()
        else:
            yield int(ids[0]), b"", b""

    def leaves(batches):
        import pyarrow as pa

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*compare(rows)), (pa.int64(), pa.binary(), pa.binary()))], ["node", "ids", "sims"])

        for rows in streams(batches):
            parts = -(-len(rows) // LEAF)
            for p in range(parts):  # a leaf of many close vectors, in parts
                yield out(rows[p::parts])

    dealt = nodes.mapInArrow(deal, "leaf long, node long, vec binary").repartitionByRange(
        max(1, (DEALS + 1) * count // (2 * LEAF)), "leaf", F.xxhash64("node")).sortWithinPartitions("leaf", F.xxhash64("node"))
    return grouped(dealt.mapInArrow(leaves, "node long, ids binary, sims binary"), merged, "node long, ids binary, sims binary")


def merged(rows):
    ids, sims = (np.concatenate([np.frombuffer(r[c], dtype=t) for r in rows]) for c, t in ((1, np.int64), (2, np.float32)))
    ids, sims = best(ids, sims, NEIGHBOURS)
    yield rows[0][0], ids.tobytes(), sims.tobytes()


def flat(lists: DataFrame) -> DataFrame:
    """(node, ids, sims) -> (node, other, sim)."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            node, ids, sims = batch.columns
            ids, sims = [np.frombuffer(b, dtype=np.int64) for b in ids.to_pylist()], [np.frombuffer(b, dtype=np.float32) for b in sims.to_pylist()]
            own = np.repeat(node.to_numpy(zero_copy_only=False), [len(i) for i in ids])
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.concatenate(ids)), pa.array(np.concatenate(sims))], ["node", "other", "sim"])

    return lists.mapInArrow(run, "node long, other long, sim float")


def edges(out: DataFrame) -> DataFrame:
    """(node, other, sim, ...) -> the same both ways and ``shown``: whether the
    other is the node's neighbour or one of the KNOWN_BY best that it is known by."""
    back = out.select(F.col("other").alias("node"), F.col("node").alias("other"), *out.columns[2:])
    nth = F.row_number().over(Window.partitionBy("node").orderBy(F.col("sim").desc(), "other"))
    return out.withColumn("shown", F.lit(True)).unionByName(back.withColumn("shown", nth <= KNOWN_BY))


def shrunk(nodes: DataFrame, book: np.ndarray) -> DataFrame:
    """(node, vec) -> (other, code, scale, small): vectors as centers and
    differences in bytes."""
    def shrink(batches):
        import pyarrow as pa

        for batch in batches:
            raw = batch.column(1).to_pylist()
            x = np.frombuffer(b"".join(raw), dtype=np.float32).reshape(len(raw), -1)
            code = nearest(x, book)
            rest = x - book[code]
            scale = np.maximum(np.abs(rest).max(axis=1), 1e-30) / 127
            small = np.rint(rest / scale[:, None]).astype(np.int8)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(code.astype(np.int32)), pa.array(scale.astype(np.float32)), pa.array([v.tobytes() for v in small], pa.binary())],
                                             ["other", "code", "scale", "small"])

    return nodes.mapInArrow(shrink, "other long, code int, scale float, small binary")


def visits(vecs: DataFrame, lists: DataFrame) -> DataFrame:
    """The graph as visits read it: (node, ids, codes, scales, small): a row for
    each node with its neighbours' shrunk vectors."""
    def collect(rows):
        seen = {r[1]: r for r in rows}
        yield (rows[0][0], np.array(list(seen), dtype=np.int64).tobytes(), np.array([r[2] for r in seen.values()], dtype=np.int32).tobytes(),
               np.array([r[3] for r in seen.values()], dtype=np.float32).tobytes(), b"".join(r[4] for r in seen.values()))

    return grouped(edges(flat(lists)).where("shown").select("node", "other").join(vecs, "other").select("node", "other", "code", "scale", "small"), collect,
                   "node long, ids binary, codes binary, scales binary, small binary")


STATE = "query long, vec binary, ids binary, sims binary, done binary"


def visit(state: DataFrame, graph: DataFrame, width: int, book: np.ndarray) -> DataFrame:
    """One round: all nodes in the beams that were not visited yet are, and
    the beams keep the ``width`` best of what they had and what they met."""
    def ask(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for query, vec, ids, sims, done in zip(*(c.to_pylist() for c in batch.columns)):
                ids, sims, done = np.frombuffer(ids, dtype=np.int64), np.frombuffer(sims, dtype=np.float32), np.frombuffer(done, dtype=bool)
                least = float(sims.min()) if len(ids) >= width else -np.inf
                out.extend((int(i), query, vec, least) for i in ids[~done])
            for i in range(0, len(out), 5000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i:i + 5000]), (pa.int64(), pa.int64(), pa.binary(), pa.float64()))],
                                                 ["node", "query", "q_vec", "least"])

    def meet(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(0, len(batch), 500):
                query, vec, least, ids, codes, scales, small = (c.to_pylist() for c in batch.slice(i, 500).columns)
                row = np.repeat(np.arange(len(query)), [len(b) // 8 for b in ids])
                ids, v = np.frombuffer(b"".join(ids), dtype=np.int64), np.frombuffer(b"".join(vec), dtype=np.float32).reshape(len(query), -1)
                rest = np.frombuffer(b"".join(small), dtype=np.int8).reshape(len(ids), -1).astype(np.float32)
                sims = np.einsum("ij,ij->i", rest, v[row]) * np.frombuffer(b"".join(scales), dtype=np.float32)
                sims += (v @ book.T)[row, np.frombuffer(b"".join(codes), dtype=np.int32)]
                near = np.flatnonzero((sims > np.array(least)[row]) & (ids != np.array(query)[row]))
                if not len(near):
                    continue
                ids, sims, row = ids[near], sims[near].astype(np.float32), row[near]
                begin = np.flatnonzero(firsts(row))
                out = [(query[row[a]], ids[a:b].tobytes(), sims[a:b].tobytes()) for a, b in zip(begin, [*begin[1:], len(row)])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary()))], ["query", "ids", "sims"])

    def keep(rows):
        own = next((r for r in rows if r[1] is not None), None)
        if own is None:
            return
        had, had_sims, done = np.frombuffer(own[2], dtype=np.int64), np.frombuffer(own[3], dtype=np.float32), np.frombuffer(own[4], dtype=bool)
        new = [r for r in rows if r[1] is None]
        ids = np.concatenate([had, *(np.frombuffer(r[2], dtype=np.int64) for r in new)])
        sims = np.concatenate([had_sims, *(np.frombuffer(r[3], dtype=np.float32) for r in new)])
        ids, sims = best(ids, sims, width)
        yield own[0], own[1], ids.tobytes(), sims.tobytes(), np.isin(ids, had).tobytes()

    asked = state.mapInArrow(ask, "node long, query long, q_vec binary, least double")
    met = asked.join(graph, "node").select("query", "q_vec", "least", "ids", "codes", "scales", "small").mapInArrow(meet, "query long, ids binary, sims binary")
    rows = state.unionByName(met.select("query", F.lit(None).cast("binary").alias("vec"), "ids", "sims", F.lit(None).cast("binary").alias("done")))
    return grouped(rows, keep, STATE)


def unvisited() -> Column:
    """Whether a beam has a node that was not visited: a zero byte."""
    return F.hex("done").rlike("^(01)*00")


def local_join(around: DataFrame, book: np.ndarray) -> DataFrame:
    """(node, other, shown, fresh, least, code, scale, small), the neighbours of each
    node and who it is known by -> (node, other, sim): each of these with each that
    is shown, unless neither is fresh, where the similarity is above its ``least``."""
    def run(batches):
        import pyarrow as pa

        for table in whole(batches):
            node, other, shown, fresh, least, code, scale, small = arrays(table)
            order = np.lexsort((fresh, ~shown, other, node))  # a neighbour both ways counts once
            order = order[firsts(node[order], other[order])]
            node, other, shown, fresh, least = node[order], other[order], shown[order], fresh[order], least[order]
            x = book[code[order]] + small[order] * scale[order, None]
            begin = firsts(node)
            group = np.cumsum(begin) - 1
            nth = np.arange(len(node)) - np.flatnonzero(begin)[group]

            def padded(values, row, at, shape):
                out = np.zeros((*shape, *values.shape[1:]), dtype=values.dtype)
                out[row, at] = values
                return out

            # who is shown, a row for each node; all of a node in blocks
            g, place = group[shown], (np.cumsum(shown) - 1)[shown]
            place -= np.flatnonzero(firsts(g))[np.cumsum(firsts(g)) - 1]
            shape = (int(group[-1]) + 1, int(place.max()) + 1)
            t_ids, t_fresh, t_vecs, t_there = (padded(c[shown], g, place, shape) for c in (other, fresh, x, np.ones(len(node), dtype=bool)))
            block, at = np.cumsum(nth % BLOCK == 0) - 1, nth % BLOCK
            of = group[nth % BLOCK == 0]
            ids, new, low, vecs, there = (padded(c, block, at, (len(of), BLOCK)) for c in (other, fresh, least, x, np.ones(len(node), dtype=bool)))
            sims = vecs @ t_vecs[of].transpose(0, 2, 1)
            met = (sims > low[:, :, None]) & (new[:, :, None] | t_fresh[of][:, None, :]) & there[:, :, None] & t_there[of][:, None, :] & (ids[:, :, None] != t_ids[of][:, None, :])
            b, i, j = np.nonzero(met)
            yield pa.RecordBatch.from_arrays([pa.array(ids[b, i]), pa.array(t_ids[of[b], j]), pa.array(sims[b, i, j].astype(np.float32))], ["node", "other", "sim"])

    return around.repartition("node").sortWithinPartitions("node").mapInArrow(run, "node long, other long, sim float")


def kept(rows: DataFrame, k: int) -> DataFrame:
    """(node, other, sim, fresh) -> of each node the k best of distinct others;
    one that was there before is not fresh."""
    def run(batches):
        import pyarrow as pa

        for table in whole(batches):
            node, other, sim, fresh = arrays(table)
            order = np.lexsort((fresh, other, node))
            order = order[firsts(node[order], other[order])]
            order = order[np.lexsort((other[order], -sim[order], node[order]))]
            begin = firsts(node[order])
            nth = np.arange(len(order)) - np.flatnonzero(begin)[np.cumsum(begin) - 1]
            order = order[nth < k]
            yield pa.RecordBatch.from_arrays([pa.array(c[order]) for c in (node, other, sim, fresh)], ["node", "other", "sim", "fresh"])

    return rows.repartition("node").sortWithinPartitions("node").mapInArrow(run, "node long, other long, sim float, fresh boolean")


def descend(nodes: DataFrame, count: int, sample: np.ndarray, book: np.ndarray) -> DataFrame:
    """The neighbour lists (node, ids, sims) after NN-descent.  Each round
    tells the driver how many neighbours there are and how many are new; lists
    only get better, so the rounds end.  Neighbours that are not new have met at
    their node before, most of them; the last round is one in which all meet."""
    vecs = written(shrunk(nodes, book), "ann-small")
    lists, share, every = written(flat(first_lists(nodes, count, sample)).withColumn("fresh", F.lit(True)), "ann-lists"), 1.0, True
    while share > CHANGED or not every:
        every = every and share == 1.0 or share <= CHANGED
        seen = Observation(uuid.uuid4().hex)
        # a list that is not full takes whoever comes
        worst = lists.groupBy("node").agg(F.when(F.count(F.lit(1)) >= NEIGHBOURS, F.min("sim")).otherwise(F.lit(float("-inf")).cast("float")).alias("least"))
        known = vecs.join(worst.withColumnRenamed("node", "other"), "other")
        around = edges(lists.withColumn("fresh", F.lit(True)) if every else lists).select("node", "other", "shown", "fresh")
        if share < QUIET and not every:
            around = around.withColumn("any", F.max("fresh").over(Window.partitionBy("node"))).where("any").drop("any")
        met = local_join(around.join(known, "other").select("node", "other", "shown", "fresh", "least", "code", "scale", "small"), book)
        better = kept(lists.withColumn("fresh", F.lit(False)).unionByName(met.withColumn("fresh", F.lit(True))), NEIGHBOURS)
        lists = written(better.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.col("fresh").cast("long")).alias("new")), "ann-lists")
        share = (seen.get["new"] or 0) / (seen.get["n"] or 1)
    return written(bound(lists), "ann-lists")


def bound(lists: DataFrame) -> DataFrame:
    """(node, other, sim, ...) -> (node, ids, sims), the best first."""
    def run(rows):
        yield rows[0][0], np.array([r[1] for r in rows], dtype=np.int64).tobytes(), np.array([r[2] for r in rows], dtype=np.float32).tobytes()

    return grouped(lists.select("node", "other", "sim", (-F.col("sim")).alias("order")), run, "node long, ids binary, sims binary", "order", "other")


def first_beams(queries: DataFrame, lists: DataFrame, vecs: DataFrame) -> DataFrame:
    """Queries (query, vec) with their own nodes' neighbours, scored anew, as beams."""
    def unpack(batches):
        import pyarrow as pa

        for batch in batches:
            ids = [np.frombuffer(b, dtype=np.int64) for b in batch.column(1).to_pylist()]
            own = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(i) for i in ids])
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.concatenate(ids))], ["query", "node"])

    def beam(rows):
        ids = np.array([r[2] for r in rows], dtype=np.int64)
        x = np.frombuffer(b"".join(r[3] for r in rows), dtype=np.float32).reshape(len(rows), -1)
        ids, sims = best(ids, x @ np.frombuffer(rows[0][1], dtype=np.float32), BEAM)
        yield rows[0][0], rows[0][1], ids.tobytes(), sims.tobytes(), bytes(len(ids))

    asked = queries.select("query").join(lists.select(F.col("node").alias("query"), "ids"), "query").mapInArrow(unpack, "query long, node long")
    met = asked.join(vecs.withColumnRenamed("vec", "other"), "node").join(queries, "query").select("query", "vec", "node", "other")
    return grouped(met, beam, STATE)


def search_graph(beams: DataFrame, graph: DataFrame, book: np.ndarray, keep: int = RESCORED) -> DataFrame:
    """Beams -> (query, node): the ``keep`` best of each after greedy search.
    A round goes over all queries; the last leaves no beam with a node that
    was not visited, which one number a round tells the driver."""
    # Dealt by node once: the rounds' joins read it where it lies.
    lying = graph.repartition("node").persist(StorageLevel.DISK_ONLY)
    state, open_beams = written(beams, "ann-beams"), 1
    while open_beams:
        seen = Observation(uuid.uuid4().hex)
        state = written(visit(state, lying, BEAM, book).observe(seen, F.sum(unvisited().cast("int")).alias("n")), "ann-beams")
        open_beams = seen.get["n"]
    lying.unpersist()

    def unpack(batches):
        import pyarrow as pa

        for batch in batches:
            ids = [np.frombuffer(b, dtype=np.int64)[:keep] for b in batch.column(1).to_pylist()]
            own = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(i) for i in ids])
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.concatenate(ids))], ["query", "node"])

    return state.select("query", "ids").mapInArrow(unpack, "query long, node long")


def score(a: Column, b: Column) -> Column:
    """Inner product in doubles, component by component."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def search(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(vec_id, embedding) -> query_id, rank, vec_id, score: of each query the
    k nearest found by inner product, all other rows being candidates.

    Vectors that are null or zero, or hold null or non-finite components, and
    rows without a vec_id take no part; vectors meet those of their own
    dimension.  Ties go to the smaller vec_id; equal vectors and repeated
    rows are candidates each; an empty table gives no row.
    """
    fine = usable(F.col("embedding")) & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull()
    rows = written(vectors.where(fine).select("vec_id", "embedding", F.xxhash64("embedding").alias("same"), F.size("embedding").alias("dim"),
                                              is_query.alias("asks")), "ann-rows")
    dims = [r["dim"] for r in rows.select("dim").distinct().collect()]
    parts = [_search(rows.where(F.col("dim") == d), k) for d in sorted(dims)]
    if not parts:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, parts)


def _search(rows: DataFrame, k: int) -> DataFrame:
    # Equal vectors: a node of the smallest id, and as many copies as any query can return.
    nth = F.row_number().over(Window.partitionBy("same").orderBy("vec_id"))
    copies = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    nodes = written(copies.groupBy("same").agg(F.min("vec_id").alias("node"), F.sort_array(F.collect_list("vec_id")).alias("members"),
                                               F.first("embedding").alias("embedding")), "ann-nodes")
    stats = nodes.agg(F.count(F.lit(1)).alias("n"), F.max(score(F.col("embedding"), F.col("embedding"))).alias("longest")).first()
    vecs = written(packed(nodes, stats["longest"]), "ann-vecs")
    sample = sampled(vecs)
    book = codebook(sample)
    lists = descend(vecs, stats["n"], sample, book)
    graph = written(visits(shrunk(vecs, book), lists), "ann-graph")
    asking = rows.where("asks").select(F.col("vec_id").alias("query_id"), "same")
    ask_nodes = nodes.join(asking.select("same").distinct(), "same", "left_semi").select(F.col("node").alias("query"), "embedding")
    asked = packed(ask_nodes.withColumnRenamed("query", "node"), None).withColumnRenamed("node", "query")
    found = search_graph(first_beams(asked, lists, vecs), graph, book)
    top = found.unionByName(ask_nodes.select("query", F.col("query").alias("node")))
    exact = top.join(nodes.select("node", "members", "embedding"), "node").join(
        ask_nodes.select("query", F.col("embedding").alias("asked")), "query").select(
        "query", F.explode("members").alias("vec_id"), score(F.col("asked"), F.col("embedding")).alias("score"))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    near = exact.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1).groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("near"))
    by_same = nodes.select("same", F.col("node").alias("query")).join(near, "query").select("same", "near")
    answers = join_back(asking.withColumnRenamed("query_id", "doc_id"), "same", by_same).withColumnRenamed("doc_id", "query_id")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return answers.select("query_id", F.posexplode(others).alias("place", "x")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))

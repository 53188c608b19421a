"""Exact top-k search by inner product with a pivot table.

Every vector's distances to a few pivots are computed once.  For a query q and
a candidate x each pivot p gives |d(q,p) - d(x,p)| <= d(q,x); the largest of
these bounds d(q,x) from below and so q.x = (|q|^2 + |x|^2 - d(q,x)^2) / 2 from
above.  Candidates are evaluated in the order of that bound until no bound
reaches the k-th best score; what is left cannot be among the k best.

Vectors are kept in blocks of bounded size, queries in blocks of their own.
Every query block first meets one block, which gives its queries a k-th best
score to start from, then all the others; a block hands on k rows for each
query at most.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import written

PIVOTS, BLOCK, QUERY_BLOCK, STEP = 32, 4096, 512, 256


def usable(vector: Column) -> Column:
    """True for vectors with components, all of them finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def quantized(vectors: DataFrame, column: str = "embedding", scale: float = 256.0) -> DataFrame:
    """vec_id and the vector of floor(scale * x) as long, x as double."""
    return vectors.where(F.col("vec_id").isNotNull() & usable(F.col(column))).select(
        "vec_id", F.transform(column, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def blocks(vectors: DataFrame, pivots: dict[int, np.ndarray], size: int, name: str) -> DataFrame:
    """(vec_id, v) -> a table of (dim, block, ids, vecs, far): at most ``size``
    vectors a row, as packed longs, with their distances to the pivots of
    their dimension.  Blocks are numbered 0.. within each dimension."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, nth = TaskContext.get().partitionId(), 0
        held: dict[int, list[tuple[int, list[int]]]] = {}

        def packed(dim, rows):
            nonlocal nth
            nth += 1
            x = np.array([v for _, v in rows], dtype=np.int64)
            far = np.linalg.norm(x[:, None, :].astype(np.float64) - pivots[dim][None], axis=2) if dim in pivots else np.zeros((len(x), 0))
            return pa.RecordBatch.from_pydict({
                "dim": [dim], "place": [(part << 32) + nth], "ids": [np.array([i for i, _ in rows], dtype=np.int64).tobytes()],
                "vecs": [x.tobytes()], "far": [far.tobytes()]}, schema=pa.schema(
                    {"dim": pa.int32(), "place": pa.int64(), "ids": pa.binary(), "vecs": pa.binary(), "far": pa.binary()}))

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = held.setdefault(len(v), [])
                rows.append((i, v))
                if len(rows) == size:
                    yield packed(len(v), held.pop(len(v)))
        for dim, rows in held.items():
            yield packed(dim, rows)

    made = written(vectors.select("vec_id", "v").mapInArrow(run, "dim int, place long, ids binary, vecs binary, far binary"), name)
    order = Window.partitionBy("dim").orderBy("place")
    numbers = made.select("dim", "place").withColumn("block", (F.row_number().over(order) - 1).cast("long"))
    return made.join(numbers, ["dim", "place"]).drop("place")


def pick_pivots(vectors: DataFrame, count: int) -> dict[int, np.ndarray]:
    """By dimension, up to ``count`` vectors with the smallest hashes (a
    bounded sample; any choice gives the same results)."""
    nth = F.row_number().over(Window.partitionBy(F.size("v")).orderBy(F.xxhash64("vec_id"), "vec_id"))
    chosen = vectors.withColumn("nth", nth).where(F.col("nth") <= count).select("v").collect()
    out: dict[int, list[list[int]]] = {}
    for r in chosen:
        out.setdefault(len(r["v"]), []).append(r["v"])
    return {dim: np.array(sorted(vs), dtype=np.float64) for dim, vs in out.items()}


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles where every sum is an exact
    double, in 64-bit integers beyond, and in Python's integers, cut off at the
    ends of 64 bits, where those could overflow."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if top < 2.0**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if top < 2.0**63:
        return q @ x.T
    wide = q.astype(object) @ x.T.astype(object)
    return np.array([[min(max(v, -2**63), 2**63 - 1) for v in row] for row in wide.tolist()], dtype=np.int64).reshape(len(q), len(x))


def best_in_block(qid, q, q_far, floor, ids, x, x_far, k: int):
    """The k best candidates of each query in one block, as index arrays
    (query, candidate) and scores; only those that reach ``floor`` matter.
    Ties go to the smaller id, a query is no candidate of its own."""
    q2, x2 = (q.astype(np.float64)**2).sum(axis=1), (x.astype(np.float64)**2).sum(axis=1)
    low = np.zeros((len(q), len(x)))
    for p in range(q_far.shape[1]):
        np.maximum(low, np.abs(q_far[:, p, None] - x_far[None, :, p]), out=low)
    slack = 1e-6 * (q2[:, None] + x2[None, :]) + 1
    upper = (q2[:, None] + x2[None, :] - low * low) / 2 + slack
    top_q, top_c, top_s = [], [], []
    order = np.argsort(-upper, axis=1, kind="stable")
    for i in range(len(q)):
        got_s, got_c, worst, have = np.empty(0, np.int64), np.empty(0, np.int64), floor[i], floor[i] > FLOOR
        for start in range(0, len(x), STEP):
            cand = order[i, start:start + STEP]
            if have and upper[i, cand[0]] < worst:
                break
            cand = cand[(ids[cand] != qid[i]) & ((upper[i, cand] >= worst) | (not have))]
            s = products(q[i:i + 1], x[cand])[0]
            got_s, got_c = np.concatenate([got_s, s]), np.concatenate([got_c, cand])
            keep = np.lexsort((ids[got_c], -got_s))[:k]
            got_s, got_c = got_s[keep], got_c[keep]
            if len(keep) == k and (not have or got_s[-1] > worst):
                worst, have = got_s[-1], True
        top_q.append(np.full(len(got_c), i))
        top_c.append(got_c)
        top_s.append(got_s)
    return np.concatenate(top_q), np.concatenate(top_c), np.concatenate(top_s)


#: No score is below this.
FLOOR = np.iinfo(np.int64).min


def search(vectors: DataFrame, is_query: Column, k: int, pivots: int = PIVOTS) -> DataFrame:
    """(vec_id, v of longs) -> query_id, rank, vec_id, score.

    All rows are candidates of all queries of their dimension but of the one
    with their own id; ties go to the smaller vec_id.  Repeated rows are
    candidates each; scores that 64 bits can't hold are the nearest that they
    can; an empty table gives no row.
    """
    vectors = written(vectors, "topk-vectors")
    chosen = pick_pivots(vectors, pivots)
    cand = written(blocks(vectors, chosen, BLOCK, "topk-made"), "topk-blocks")
    asked = blocks(vectors.where(is_query), chosen, QUERY_BLOCK, "topk-queries").select(
        "dim", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"), F.col("far").alias("q_far"))
    asked = written(asked, "topk-asked")
    sizes = cand.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    tasks = max(1, 2 * cand.count())
    home = F.pmod(F.xxhash64("q_block"), F.col("n"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                dim = r["dim"]
                q_ids, ids = (np.frombuffer(r[c], dtype=np.int64) for c in ("q_ids", "ids"))
                q, x = (np.frombuffer(r[c], dtype=np.int64).reshape(-1, dim) for c in ("q_vecs", "vecs"))
                q_far, x_far = (np.frombuffer(r[c]).reshape(len(v), -1) for c, v in (("q_far", q), ("far", x)))
                floor = np.frombuffer(r["floor"], dtype=np.int64) if r["floor"] else np.full(len(q), FLOOR)
                a, b, s = best_in_block(q_ids, q, q_far, floor, ids, x, x_far, k)
                cols = (np.full(len(a), dim, dtype=np.int32), np.full(len(a), r["q_block"], dtype=np.int64), a, q_ids[a], ids[b], s)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in cols], ["dim", "q_block", "nth", "query_id", "vec_id", "score"])

    found = "dim int, q_block long, nth long, query_id long, vec_id long, score long"
    by_rank = Window.partitionBy("q_block", "nth", "dim").orderBy(F.col("score").desc(), "vec_id")

    def meet(pairs: DataFrame) -> DataFrame:
        """Query blocks go to the candidates' blocks; a block's task meets them one at a time."""
        rows = pairs.repartition(tasks, "dim", "block").join(cand.repartition(tasks, "dim", "block"), ["dim", "block"])
        return rows.select("dim", "q_block", "q_ids", "q_vecs", "q_far", "floor", "ids", "vecs", "far").mapInArrow(run, found)

    first = written(meet(asked.join(sizes, "dim").withColumn("block", home).withColumn("floor", F.lit(None).cast("binary"))), "topk-first")
    kth = first.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") == k).groupBy("dim", "q_block").agg(
        F.collect_list(F.struct("nth", "score")).alias("kth"))  # at most a query block's

    def floors(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for ids, kth in zip(batch.column("q_ids").to_pylist(), batch.column("kth").to_pylist()):
                f = np.full(len(ids) // 8, FLOOR)
                for e in kth or []:
                    f[e["nth"]] = e["score"]
                out.append(f.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.binary())], [*batch.schema.names[:-1], "floor"])

    schema = T.StructType([*asked.schema.fields, T.StructField("floor", T.BinaryType())])
    ready = asked.join(kth, ["dim", "q_block"], "left").select(*asked.columns, "kth").mapInArrow(floors, schema)
    rest = ready.join(sizes, "dim").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).where(F.col("block") != home)
    every = first.unionByName(meet(rest))
    return every.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

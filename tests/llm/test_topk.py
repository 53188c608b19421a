import math
import random

from pyspark.sql import functions as F

from tributary.llm import topk

SCHEMA = "vec_id long, embedding array<float>, v string"


def brute(rows, every, k):
    fine = [(i, [math.floor(256 * x) for x in e]) for i, e, *_ in rows
            if i is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, v in fine:
        if q % every == 0:
            scored = sorted((-min(max(sum(a * b for a, b in zip(v, w)), -2**63), 2**63 - 1), c) for c, w in fine if c != q and len(w) == len(v))[:k]
            out += [(q, n, c, -s) for n, (s, c) in enumerate(scored, 1)]
    return sorted(out)


def search(spark, rows, every=5, k=4):
    vectors = topk.quantized(spark.createDataFrame(rows, SCHEMA))
    return sorted(map(tuple, topk.search(vectors, F.col("vec_id") % every == 0, k).collect()))


def single(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


def test_exact_with_ties_and_clusters(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "STEP", 8)
    rnd = random.Random(1)
    rows = []
    for i in range(300):
        kind = i % 3
        center = [1.0, 0, 0, 0, 0, 0] if kind == 0 else [rnd.gauss(0, 1) for _ in range(6)]
        rows.append((i, [single(c + rnd.gauss(0, 0.01 if kind else 0)) for c in center], "x"))
    assert search(spark, rows) == brute(rows, 5, 4)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], None), (5, None, "x"), (10, [], "x"), (15, [None, 1.0], "x"), (20, [nan, 1.0], "x"), (25, [inf, 1.0], "x"), (None, [1.0, 1.0], "x"),
            (30, [1.0, 0.5], "x"), (1, [-0.25, 2.0], "x"), (35, [1.0, 2.0, 3.0], "x"), (2, [0.0, 0.0], "x"), (40, [3e5, 1e6], "x"), (3, [2e6, -1e6], "x"), (45, [3e7, 1e8], "x"), (4, [2e8, -1e8], "x")]
    assert search(spark, rows, k=10) == brute(rows, 5, 10)
    assert search(spark, rows[:0]) == []
    one = search(spark, [(0, [1.0], "x")])
    assert one == []

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import ann

SCHEMA = "vec_id long, embedding array<float>, node string"


def search(spark, rows, every=20, k=5):
    out = {}
    for r in ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % every == 0, k).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


def brute(rows, every, k):
    fine = [(i, np.array(e, dtype=np.float32).astype(float)) for i, e, _ in rows if i is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    out = {}
    for q, v in fine:
        if q % every == 0:
            scored = sorted((-float((v * w).sum()), i) for i, w in fine if i != q and len(w) == len(v))[:k]
            out[q] = [(n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return out


@pytest.mark.parametrize("lengths", [False, True])
def test_recall(spark, monkeypatch, lengths):
    monkeypatch.setattr(ann, "LEAF", 256)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 24))
    x[:600] = x[0] + 0.05 * rng.normal(size=(600, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths:
        x *= rng.uniform(0.5, 2, (2000, 1))
    rows = [(i, [float(v) for v in e], "x") for i, e in enumerate(x.astype(np.float32))]
    got, want = search(spark, rows, 20, 10), brute(rows, 20, 10)
    assert got.keys() == want.keys()
    recall = np.mean([len({v for _, v, _ in got[q]} & {v for _, v, _ in want[q]}) / 10 for q in want])
    assert recall >= 0.9
    for q, found in got.items():
        assert [n for n, _, _ in found] == list(range(1, 11))
        assert found == sorted(found, key=lambda r: (-r[2], r[1]))


def test_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 0.5, -1.0], "x") for i in range(0, 90)]  # more copies than any query returns
    rows += [(100 + i, [float(v) for v in rng.normal(size=3).astype(np.float32)], "x") for i in range(30)]
    rows += [(200, None, "x"), (220, [0.0, 0.0, 0.0], "x"), (240, [float("nan"), 1.0, 1.0], "x"), (260, [None, 1.0, 1.0], "x"), (280, [], "x"),
             (None, [1.0, 1.0, 1.0], "x"), (300, [1.0, 2.0], None), (301, [2.0, 1.0], None), (320, [7.0], "x")]
    got, want = search(spark, rows), brute(rows, 20, 5)
    want = {q: v for q, v in want.items() if v}
    assert {q: [(n, v) for n, v, _ in r] for q, r in got.items()} == {q: [(n, v) for n, v, _ in r] for q, r in want.items()}
    assert all(abs(a[2] - b[2]) < 1e-12 for q in want for a, b in zip(got[q], want[q]))


def test_empty(spark):
    assert search(spark, []) == {}
    assert search(spark, [(0, None, "x")]) == {}


def test_rounds_go_on_until_lists_are_good(spark, monkeypatch):
    for name, value in {"LEAF": 64, "DEALS": 1, "CHANCE": 16, "NEIGHBOURS": 10, "KNOWN_BY": 10}.items():
        monkeypatch.setattr(ann, name, value)
    x = np.random.default_rng(6).normal(size=(4000, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    nodes = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "node long, embedding array<double>")
    vecs = ann.packed(nodes, None).persist()
    sample = ann.sampled(vecs)
    lists = ann.descend(vecs, len(x), sample, ann.codebook(sample)).collect()
    sims = x @ x.T
    np.fill_diagonal(sims, -np.inf)
    want = np.argsort(-sims, axis=1)[:, :10]
    recall = np.mean([len({*np.frombuffer(r["ids"], dtype=np.int64)} & {*want[r["node"]]}) / 10 for r in lists])
    assert len(lists) == len(x) and recall >= 0.9


def test_local_join_meets_all_but_old_pairs(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(120, 6)).astype(np.float32)
    rows, shown_at, all_at = [], {}, {}
    for node in range(30):
        others = rng.choice(120, size=100 if node == 3 else 12, replace=False)  # one is known by many
        for n, o in enumerate(others):
            shown, fresh = bool(n < 10), bool(rng.random() < 0.3)
            rows.append((node, int(o), shown, fresh))
            all_at.setdefault(node, {})[int(o)] = fresh
            if shown:
                shown_at.setdefault(node, {})[int(o)] = fresh
    least = {i: float(v) for i, v in enumerate(rng.normal(size=120).astype(np.float32))}
    book = ann.codebook(x)
    vecs = ann.shrunk(spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(x)], "node long, vec binary"), book)
    low = spark.createDataFrame(list(least.items()), "other long, least float")
    around = spark.createDataFrame(rows + rows[:5], "node long, other long, shown boolean, fresh boolean").join(vecs.join(low, "other"), "other")
    got = [(r["node"], r["other"], r["sim"]) for r in ann.local_join(around.select("node", "other", "shown", "fresh", "least", "code", "scale", "small"), book).collect()]
    want = [(a, b) for node in all_at for a, new in all_at[node].items() for b, new_too in shown_at[node].items()
            if a != b and (new or new_too) and x[a] @ x[b] > least[a]]
    assert sorted(want) == sorted((a, b) for a, b, _ in got)
    assert all(abs(s - x[a] @ x[b]) < 0.05 for a, b, s in got)


def test_kept_lists_are_the_best_of_distinct_others(spark, monkeypatch):
    rng = np.random.default_rng(9)
    sims = rng.normal(size=(40, 300)).astype(np.float32)
    rows = [(int(n), int(o), float(sims[n, o]), bool(f)) for n in range(40) for o, f in zip(rng.integers(0, 300, 50 if n else 2000), rng.random(2000) < 0.5)]
    got = sorted((r["node"], -r["sim"], r["other"], r["fresh"]) for r in ann.kept(spark.createDataFrame(rows, "node long, other long, sim float, fresh boolean"), 7).collect())
    want = []
    for n in range(40):
        seen = {}
        for m, o, s, f in rows:
            if m == n:
                seen[o] = seen.get(o, True) and f
        want += sorted((n, -float(sims[n, o]), o, f) for o, f in seen.items())[:7]
    assert got == want


def test_groups_are_never_split_between_chunks():
    import pyarrow as pa

    key = np.sort(np.random.default_rng(10).integers(0, 40, 5000))
    key[2000:4000] = key[2000]
    key = np.sort(key)
    batches = pa.Table.from_arrays([pa.array(key), pa.array(np.arange(5000))], ["k", "v"]).to_batches(max_chunksize=90)
    chunks = [t.column(0).to_numpy() for t in ann.whole([batches[0].slice(0, 0), *batches], 200)]
    assert (np.concatenate(chunks) == key).all() and len(chunks) > 5
    assert all(a[-1] < b[0] for a, b in zip(chunks, chunks[1:]))


def test_lists_end_where_a_whole_round_finds_no_more(spark):
    x = np.random.default_rng(12).normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    vecs = ann.packed(spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "node long, embedding array<double>"), None).persist()
    sample = ann.sampled(vecs)
    book = ann.codebook(sample)
    lists = ann.descend(vecs, len(x), sample, book)
    out = ann.flat(lists).withColumn("fresh", F.lit(False)).persist()
    around = ann.edges(out.withColumn("fresh", F.lit(True))).join(ann.shrunk(vecs, book), "other").withColumn("least", F.lit(-2.0).cast("float"))
    met = ann.local_join(around.select("node", "other", "shown", "fresh", "least", "code", "scale", "small"), book).withColumn("fresh", F.lit(True))
    again = ann.kept(out.unionByName(met), ann.NEIGHBOURS)
    assert again.where("fresh").count() <= 2 * ann.CHANGED * out.count()

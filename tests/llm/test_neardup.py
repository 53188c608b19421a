import random

import pytest
from pyspark.sql import functions as F

from tributary.llm import neardup as N
from tributary.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def words_of(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ")


def brute(rows, words, percent):
    sets = []
    for i, t in rows:
        w = [x for x in words_of(t) if x]
        sets.append((i, {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()))
    up = {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            both = len(x & y)
            if both and 100 * both >= percent * (len(x) + len(y) - both):
                u, v = root(a), root(b)
                up[max(u, v)] = min(u, v)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets}


def found(docs, words, percent):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(docs, words, percent).collect()}


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_against_brute_force(spark, words, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(docs, words, percent) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], words, percent)


def near_copies(n, base_words, changes, seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdefghij", k=6))
    base, out = [word() for _ in range(base_words)], []
    for _ in range(n):
        text = list(base)
        for _ in range(rnd.randint(0, changes)):
            text[rnd.randrange(base_words)] = word()
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("gathered", [N.GATHERED, 40])
def test_large_groups_of_near_copies(spark, monkeypatch, gathered):
    # with few gathered, nodes are branched and dealt out by Spark
    monkeypatch.setattr(N, "GATHERED", gathered)
    monkeypatch.setattr(N, "LEAF", 8)
    monkeypatch.setattr(N, "LEVELS", 2)
    texts = near_copies(150, 200, 5, 1) + near_copies(30, 80, 4, 2) + [t for s in range(10, 30) for t in near_copies(2, 60, 3, s)]
    rows = list(enumerate(texts))
    random.Random(5).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs, 3, 85) == brute(rows, 3, 85)


def test_links_on_the_edge_of_the_similarity(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for n in range(1, 13):  # n changed words in a run: similarity falls through 0.85
        rows.append((n, " ".join(base[:60] + [f"x{n}_{k}" for k in range(n)] + base[60 + n:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs, 3, 85) == brute(rows, 3, 85)


def test_edge_rows(spark):
    long_text = "word%d " * 30_000 % tuple(range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "one"), (7, "É a"), (8, "é a"), (9, long_text), (10, long_text + " x"), (11, "one two"), (12, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cid", F.lit("clash")).withColumn("kept", F.lit(1))
    assert found(docs, 3, 85) == brute(rows, 3, 85)
    twice = spark.createDataFrame([(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "z y x"), (1, "q")], "doc_id long, text string")
    got = sorted(map(tuple, N.near_duplicates(twice, 3, 85).collect()), key=str)
    assert got == sorted([(3, 2, 3, True), (3, 2, 3, True), (None, 2, 3, False), (None, 1, None, True), (1, 1, 1, True)], key=str)
    assert N.near_duplicates(twice.limit(0)).count() == 0


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(rnd.randrange(300), rnd.randrange(300)) for _ in range(120)] + [(5000, k) for k in range(6000, 6200)] + [(7, 7), (None, 3)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got.get(x, x) == root(x) for x in up)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tributary.llm import ctw
from tributary.llm.queries import op13_lm_scoring

SF_SMALL = "/root/testdata/sf0.001"


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


class Tree:
    """Context-tree weighting with one dict and recursion."""

    def __init__(self, texts):
        self.n, self.kids = defaultdict(lambda: [0, 0]), defaultdict(set)
        for before, z, bit in (d for t in texts for d in decisions(t)):
            for k in range(ctw.ORDER + 1):
                self.n[before[ctw.ORDER - k:], z][bit] += 1
                if k:
                    self.kids[before[ctw.ORDER - k + 1:], z].add(before[ctw.ORDER - k:])
        self.logs = {}

    def own(self, node):
        a, b = self.n[node] if node in self.n else (0, 0)
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def log(self, node):
        if node not in self.logs:
            own = self.own(node)
            if len(node[0]) < ctw.ORDER:
                own = math.log(0.5) + np.logaddexp(own, sum(self.log((k, node[1])) for k in self.kids[node]))
            self.logs[node] = own
        return self.logs[node]

    def one(self, before, z, k=0):
        """Probability of a one from the node of the last k bytes on."""
        node = before[ctw.ORDER - k:], z
        a, b = self.n[node] if node in self.n else (0, 0)
        kt = (b + 0.5) / (a + b + 1)
        if k == ctw.ORDER or (before[ctw.ORDER - k - 1:], z) not in self.n:
            return kt
        w = math.exp(math.log(0.5) + self.own(node) - self.log(node))
        return w * kt + (1 - w) * self.one(before, z, k + 1)

    def score(self, text):
        return sum(math.log10(p if bit else 1 - p) for p, bit in ((self.one(b, z), bit) for b, z, bit in decisions(text)))


def decisions(text):
    data = text.encode().lower() + b"\xff"
    for i, byte in enumerate(data):
        before, z = (b"\0" * ctw.ORDER + data)[i:i + ctw.ORDER], 1
        for j in range(7, -1, -1):
            yield before, z, byte >> j & 1
            z = 2 * z + (byte >> j & 1)


def expected(rows):
    rows = [(d, t or "") for d, t in rows]
    tokens = [[w.decode() for w in t.encode().lower().split()] + [None] for _, t in rows]
    n = Counter(w for (d, _), ws in zip(rows, tokens) if not held(d) for w in ws)
    total, v = sum(n.values()), len(n)
    tree = Tree([t for d, t in rows if not held(d)])
    return [(d, held(d), len(ws), sum(n[w] > 0 for w in ws), total,
             sum(math.log10((n[w] + 0.1) / (total + 0.1 * (v + 1))) for w in ws), tree.score(t)) for (d, t), ws in zip(rows, tokens)]


def same(df, rows):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])
    got, want = sorted((tuple(r) for r in df.collect()), key=key), sorted(expected(rows), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-9)


TEXTS = ["Abc abd\nabc", "the the then", "", None, "É è\x00\x0b Ünder", "zzz", "the abc zz qq", " x  y", "Then abd the", "🤦"]


def test_against_recursion(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["The", "then", "abc", "abd", "é", "q"]) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    rows += [(100 + i, t) for i, t in enumerate(TEXTS)] + [(100, TEXTS[0]), (None, "null id"), (None, "the abc")]
    df = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, block int, word string")
    same(ctw.score_documents(df.repartition(3)), rows)


@pytest.fixture
def tiny(monkeypatch):
    """Sizes that make one test text go over many blocks, pieces and chunks.  The
    module is sent to tasks by value, so that they see them."""
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(ctw)
    for name, value in (("BLOCK", 300), ("PACK", 60), ("PIECE", 7), ("CHUNK", 50), ("ROWS", 30)):
        monkeypatch.setattr(ctw, name, value)
    yield
    cloudpickle.unregister_pickle_by_value(ctw)


def test_blocks_pieces_and_chunks_change_nothing(spark, tiny):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("abc deé\n") for _ in range(rng.choice([0, 3, 40, 150])))) for i in range(40)]
    same(ctw.score_documents(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_no_documents_and_no_training_documents(spark):
    schema = "doc_id long, text string"
    assert ctw.score_documents(spark.createDataFrame([], schema)).count() == 0
    rows = [(d, "a b") for d in range(200) if held(d)][:3]
    same(ctw.score_documents(spark.createDataFrame(rows, schema)), rows)


def test_long_words_and_texts(spark):
    rows = [(1, "x" * 3_000_000), (2, "ab " * 500_000), (3, "x")]
    out = {r["doc_id"]: r for r in ctw.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[2]["n_tokens"] == 500_001 and out[1]["n_tokens"] == 2 and out[1]["score"] > -1000


def test_probabilities_sum_to_one():
    """Over all bytes after one context."""
    tree, total = Tree(["abc abd", "abab"]), 0
    for b in range(256):
        p, z = 1, 1
        for j in range(7, -1, -1):
            one = tree.one(b"abc a", z)
            p, z = p * (one if b >> j & 1 else 1 - one), 2 * z + (b >> j & 1)
        total += p
    assert abs(total - 1) < 1e-9


def test_lgamma():
    x = np.array([0.5, 1, 1.5, 7.25, 15.9, 16, 1000.5, 1e9])
    assert np.allclose(ctw._lgamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-11)


def test_better_than_words_on_held_out_documents(spark):
    rows = [r for r in op13_lm_scoring(spark, SF_SMALL).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) * 1.2
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert op13_lm_scoring(spark, SF_SMALL).count() == n

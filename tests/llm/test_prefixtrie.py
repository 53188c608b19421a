import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tributary.llm import prefixtrie
from tributary.llm.prefixtrie import SlotTable

SCHEMA = "conv_id long, turn long, role string, text string"


def heads(c):
    return zlib.crc32(str(c).encode()) % 4


def expected(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    trie = defaultdict(list)
    for c, turns in own.items():
        turns = own.get(c - c % 20, [])[:heads(c)] + turns[heads(c):]
        for d in range(len(turns) + 1):
            trie[tuple(turns[:d])].append((c, d == len(turns)))
    out = set()
    for key, members in trie.items():
        below = [k for k in trie if k[:len(key)] == key]
        kids = {k[:-1] for k in trie if k}
        saved = sum((len(trie[k]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) for k in below if k)
        ends = ",".join(str(c) for c in sorted(c for c, e in members if e))
        out.add((min(members)[0], len(key), min(trie[key[:-1]])[0] if key else None, len(members), sum(len(k) == len(key) + 1 for k in below),
                 sum(k not in kids for k in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def nodes(spark, rows, schema=SCHEMA, **options):
    c = F.col("conv_id")
    turns = prefixtrie.conversation_turns(spark.createDataFrame(rows, schema))
    df = prefixtrie.trie_nodes(prefixtrie.grafted(turns, c - c % 20, (F.crc32(c.cast("string").cast("binary")) % 4).cast("int")), **options)
    found = [tuple(r) for r in df.collect()]
    assert len(set(found)) == len(found)
    return set(found)


def branching(n, seed=3):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(["one two", "three", "", "x\ty z"])) for c in range(n) for t in range(rng.randint(1, 6))]


def test_small_subtrees_and_many_shards(spark):
    rows = branching(150)
    assert nodes(spark, rows, bound=5, shard=40) == expected(rows)


def test_one_shard(spark):
    rows = branching(60, 4)
    assert nodes(spark, rows) == expected(rows)


def test_copies_and_one_long_conversation(spark):
    """A third of all rows is one conversation; many ids share another."""
    rows = [(20, t, "user", f"turn {t}") for t in range(400)] + [(c, t, "user", f"same {t}") for c in range(21, 200) for t in range(4)]
    assert nodes(spark, rows, bound=50) == expected(rows)


def test_edge_rows(spark):
    rows = [(1, None, None, None, 1), (1, 0, "user", "a", 1), (1, 0, "user", "a", 1), (None, 0, "user", "lost", 1), (0, 0, "user", "w " * 50_000, 1),
            (7, 2, "user\n", "a b", 1), (9, 2, "us", "er\na b", 1), (8, 0, "", "b", 1)]
    assert nodes(spark, rows, SCHEMA + ", digest int") == expected([r[:4] for r in rows])
    assert nodes(spark, [], SCHEMA) == set()


def test_conversation_left_without_turns_is_in_the_root(spark):
    lone = next(c for c in range(21, 40) if heads(c) == 3)
    out = nodes(spark, [(lone, 0, "user", "gone")])
    assert out == {(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())}


def test_ends_over_several_ranges(spark):
    rows = [(c * 20, 0, "user", "x") for c in range(1000)]
    assert nodes(spark, rows) == expected(rows)


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, (5000, 2)).astype(np.uint64), axis=0)
    table = SlotTable(keys)
    assert sorted(table.slots(keys)) == list(range(len(keys)))
    assert (table.slots(keys + np.uint64(1)) == -1).all()
    assert len(SlotTable(keys[:0]).slots(keys[:0])) == 0

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tributary.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
WORDS, REFERENCE = packing.WordIds(PATH), Tokenizer.from_file(PATH)


def placed(counts, capacity):
    bins, ranks = {}, Counter()
    for length, first, n, first_bin, per, offset in packing.plan_bins(counts, capacity):
        assert first == ranks[length]
        ranks[length] += n
        for k in range(n):
            bins.setdefault(first_bin + k // per, []).append((offset + k % per * length, length))
    assert ranks == Counter({k: v for k, v in counts.items() if v})
    for inside in bins.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(bins) == list(range(len(bins)))
    return bins


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 90), st.data())
def test_bins_are_gapless_and_whole(capacity, data):
    counts = data.draw(st.dictionaries(st.integers(1, capacity), st.integers(1, 40), max_size=25))
    bins = placed(counts, capacity)
    total = sum(k * v for k, v in counts.items())
    most = max(-(-total // capacity), sum(v for k, v in counts.items() if 2 * k > capacity))
    assert len(bins) <= 1.5 * most + 1
    assert all(sum(3 * n > capacity for _, n in inside) <= 2 for inside in bins.values())


def test_as_many_large_pairs_as_possible():
    # 7 alone, 6 with 4, 5 with 5: the least there can be.
    assert len(placed({7: 1, 6: 1, 5: 2, 4: 1}, 10)) == 3
    assert len(placed({6: 2, 4: 2}, 10)) == 2
    assert len(placed({5: 3, 4: 1}, 10)) == 2


def test_plan_is_small_whatever_the_counts():
    rng = np.random.default_rng(0)
    few = packing.plan_bins({n: int(c) for n, c in zip(range(1, 2049), rng.integers(1, 50, 2048))}, 2048)
    many = packing.plan_bins({n: int(c) * 10**9 for n, c in zip(range(1, 2049), rng.integers(1, 50, 2048))}, 2048)
    assert len(few) < 25_000 and len(many) < 25_000


def test_ids_are_the_tokenizers_own():
    odd = ["", " ", "a", "Word. word! İx ÀB", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "it's 12 ٣٤ 你好 x\x1cy \x85z　w", "é é é ́x",
           "YENİ. İYİ, HAYDİ! SERGİ:", "ΣΑΣ", "\0 a\0b", "x" * 3000, "ﬁ ǅ ŉ", "a.b,c;d"]
    ref = Tokenizer.from_file(PATH)
    for _ in range(2):
        got = [np.frombuffer(b, dtype="<u4").tolist() for b in packing.WordIds(PATH).packed(odd)]
        assert got == [e.ids for e in ref.encode_batch(odd, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.one_of(st.text(alphabet="abİıßſÀéÉ.,!:;'ŉǅΣσ1 \u0307\u0301", max_size=9), st.text(max_size=6)), max_size=6).map(" ".join), max_size=20))
def test_any_text_has_the_tokenizers_ids(texts):
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in WORDS.packed(texts)]
    assert got == [e.ids for e in REFERENCE.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("capacity", [2048, 50])
def test_documents(spark, capacity):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1, None), (-2, ""), (-3, "word " * 5000)], "doc_id long, text string"))
    rows = packing.pack_documents(docs, PATH, capacity).collect()
    ref, want, have = Tokenizer.from_file(PATH), {}, {}
    for r in docs.collect():
        ids = np.array(ref.encode(r["text"] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        want[r["doc_id"]] = [(p, s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes())) for p, s in enumerate(range(0, len(ids), capacity))]
    seqs = {}
    for r in rows:
        have.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert {k: sorted(v) for k, v in have.items()} == want
    for inside in seqs.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(seqs) <= 1.02 * sum(x[2] for v in want.values() for x in v) / capacity + 1
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (1, "a b", "t"), (None, "a", None)], "doc_id long, text string, sequence_id string")
    rows = packing.pack_documents(docs, PATH, 4).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 2), (1, 3), (1, 3)]

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import langid

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    texts = {"aa": "abba baba abab ", "zz": "zyxz xyzzy zyzy "}
    return langid.train([(t * 12, lang) for lang, t in texts.items()] * 3, steps=60)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    m = langid.Model(["a", "b"], *(rng.normal(0, 0.5, s) for s in ((2, 6, 256), (2, 6, 2), (2, 4), (2, 1))))
    windows, labels = rng.integers(97, 100, (5, 3)).astype(np.uint8), np.array([0, 1, 1])
    m.of_byte, m.of_state, m.out, m.out_bias = (w.astype(np.float64) for w in (m.of_byte, m.of_state, m.out, m.out_bias))
    weights = [m.of_byte, m.of_state, m.out, m.out_bias]
    grads, _ = langid._gradients(m, windows, labels)
    for w, g, at in zip(weights, grads, ((1, 3, 98), (0, 4, 1), (1, 2), (0, 0))):
        old, losses = w[at], []
        for step in (1e-2, -1e-2):
            w[at] = old + step
            losses.append(langid._gradients(m, windows, labels)[1])
        w[at] = old
        assert g[at] == pytest.approx((losses[0] - losses[1]) / 2e-2, rel=0.02, abs=1e-4)


def test_every_position_is_labelled_and_pooled(model):
    text = b"abab zyzy" * 30
    windows, weights, counts = langid.windows_of([text, b"", b"q"])
    assert counts.tolist() == [-(-len(text) // langid.WINDOW), 0, 1]
    assert weights.sum() == len(text) + 1
    p = langid.position_probabilities(model, windows)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)
    pooled = langid.document_probabilities(model, [text, b"", b"q"], block=2)
    n = counts[0]
    want = (p[:, :, :n] * weights[:, None, :n]).sum(axis=(0, 2)) / len(text)
    assert np.allclose(pooled[0], want, atol=1e-5) and pooled[1].tolist() == [0, 0]


def test_edge_rows(spark, model):
    rows = [(1, None, "x"), (2, "", None), (3, "123 !?", "x"), (None, "abab baba", None), (5, "zyxz " * 50_000, "y"), (5, "zyxz " * 50_000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = langid.predict(docs, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score"]
    out = [(r["doc_id"], r["lang_pred"]) for r in got.orderBy(F.col("doc_id").asc_nulls_first()).collect()]
    assert out == [(None, "aa"), (1, "und"), (2, "und"), (3, "und"), (5, "zz"), (5, "zz")]
    assert langid.predict(docs.limit(0), model).count() == 0
    none = langid.identify(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")).first()
    assert (none["lang_pred"], none["score"]) == ("und", 0.0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.identify(docs).withColumn("out", langid.held_out(F.col("doc_id"))).collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    judged = [r for r in rows if r["out"] and r["lang"] and r["lang_pred"] != "und"]
    assert len(judged) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in judged) / len(judged) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)

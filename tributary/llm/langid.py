"""Language identification by a bidirectional gated recurrent network on bytes.

The network reads windows of UTF-8 bytes forwards and backwards, gives every
position a probability for each language, and a document's probabilities are
the mean over all of its positions.  It is trained here, in numpy, by
backpropagation through time, on a bounded sample of labelled rows; prediction
runs in tasks on whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW, HIDDEN = 64, 8
#: Of each language at most so many rows are learnt from, a snippet of so many characters of each.
ROWS_PER_LANGUAGE, SNIPPET = 600, 384
STEPS, BATCH, RATE = 300, 128, 0.02
UNKNOWN = "und"


@dataclass
class Model:
    """Weights by direction (0 forwards, 1 backwards); gates in the order
    update, reset, candidate."""

    languages: list[str]
    of_byte: np.ndarray    # (2, 3H, 256): input weights and biases
    of_state: np.ndarray   # (2, 3H, H)
    out: np.ndarray        # (L, 2H)
    out_bias: np.ndarray   # (L, 1)


def _gates(x: np.ndarray, s: np.ndarray, h: int) -> tuple[np.ndarray, ...]:
    """Update and reset gates (together) and the candidate state."""
    zr = x[:2 * h] + s[:2 * h]
    np.negative(zr, out=zr)
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    n = zr[h:] * s[2 * h:]
    n += x[2 * h:]
    np.tanh(n, out=n)
    return zr, n


def _states(m: Model, d: int, windows: np.ndarray) -> np.ndarray:
    """(window length, H, windows): one direction's state at every position."""
    size, b = windows.shape
    h = m.of_state.shape[2]
    out = np.empty((size, h, b), dtype=np.float32)
    state = np.zeros((h, b), dtype=np.float32)
    for t in range(size) if d == 0 else range(size - 1, -1, -1):
        zr, n = _gates(m.of_byte[d].take(windows[t], axis=1), m.of_state[d] @ state, h)
        state = state - n
        state *= zr[:h]
        state += n
        out[t] = state
    return out


def position_probabilities(m: Model, windows: np.ndarray) -> np.ndarray:
    """(window length, windows) bytes -> (window length, languages, windows)."""
    logits = m.out @ np.concatenate([_states(m, 0, windows), _states(m, 1, windows)], axis=1)
    logits += m.out_bias
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _gradients(m: Model, windows: np.ndarray, labels: np.ndarray) -> tuple[list[np.ndarray], float]:
    """Of the mean cross entropy over all positions, by backpropagation
    through time; in the order of the model's weights."""
    size, b = windows.shape
    h = m.of_state.shape[2]
    kept = []
    for d in (0, 1):
        state, steps = np.zeros((h, b), dtype=np.float32), {}
        for t in range(size) if d == 0 else range(size - 1, -1, -1):
            s = m.of_state[d] @ state
            zr, n = _gates(m.of_byte[d].take(windows[t], axis=1), s, h)
            new = n + zr[:h] * (state - n)
            steps[t] = (state, s[2 * h:], zr, n, new)
            state = new
        kept.append(steps)
    states = np.stack([np.concatenate([kept[0][t][4], kept[1][t][4]]) for t in range(size)])
    p = m.out @ states + m.out_bias
    p -= p.max(axis=1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    loss = float(-np.log(p[:, labels, np.arange(b)] + 1e-9).mean())
    p[:, labels, np.arange(b)] -= 1
    p /= size * b
    d_out = np.einsum("tlb,thb->lh", p, states)
    d_bias = p.sum(axis=(0, 2))[:, None]
    d_states = m.out.T @ p
    d_byte, d_state = np.zeros_like(m.of_byte), np.zeros_like(m.of_state)
    for d in (0, 1):
        back = np.zeros((h, b), dtype=np.float32)
        inputs = np.empty((size, 3 * h, b), dtype=np.float32)
        for t in range(size - 1, -1, -1) if d == 0 else range(size):
            prev, sn, zr, n, _ = kept[d][t]
            back = back + d_states[t, d * h:(d + 1) * h]
            a_n = back * (1 - zr[:h]) * (1 - n * n)
            a_zr = np.concatenate([back * (prev - n), a_n * sn]) * zr * (1 - zr)
            inputs[t] = np.concatenate([a_zr, a_n])
            from_state = np.concatenate([a_zr, a_n * zr[h:]])
            d_state[d] += from_state @ prev.T
            back = back * zr[:h] + m.of_state[d].T @ from_state
        flat = inputs.transpose(1, 0, 2).reshape(3 * h, -1)
        d_byte[d] = [np.bincount(windows.ravel(), weights=row, minlength=256) for row in flat]
    return [d_byte, d_state, d_out, d_bias], loss


def windows_of(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (size, n) that hold the texts one after the other, each padded
    with spaces; weights of the positions (0 where padded); each text's windows."""
    counts = np.array([-(-len(t) // size) for t in texts], dtype=np.int64)
    flat = np.frombuffer(b"".join(t.ljust(int(c) * size) for t, c in zip(texts, counts)), dtype=np.uint8).reshape(-1, size)
    filled = np.full(len(flat), size, dtype=np.int64)
    has = counts > 0
    filled[np.cumsum(counts)[has] - 1] = np.array([len(t) - (int(c) - 1) * size for t, c in zip(texts, counts)], dtype=np.int64)[has]
    return np.ascontiguousarray(flat.T), (np.arange(size)[:, None] < filled), counts


def train(samples: list[tuple[str, str]], steps: int = STEPS, seed: int = 7) -> Model | None:
    """(text, language) pairs -> the trained network; None without any.
    Every batch draws its languages evenly."""
    languages = sorted({lang for _, lang in samples})
    if not languages:
        return None
    by_lang = []
    for lang in languages:
        w, weights, _ = windows_of(sorted(t.encode() for t, of in samples if of == lang and t))
        by_lang.append(w[:, weights.mean(axis=0) > 0.5] if w.shape[1] else w)
    by_lang = [w if w.shape[1] else np.full((WINDOW, 1), 32, dtype=np.uint8) for w in by_lang]
    rng, n = np.random.default_rng(seed), len(languages)

    def normal(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.3, shape).astype(np.float32)

    m = Model(languages, normal(2, 3 * HIDDEN, 256), normal(2, 3 * HIDDEN, HIDDEN), normal(n, 2 * HIDDEN), np.zeros((n, 1), np.float32))
    weights = [m.of_byte, m.of_state, m.out, m.out_bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        labels = rng.integers(0, n, BATCH)
        batch = np.stack([by_lang[k][:, rng.integers(by_lang[k].shape[1])] for k in labels], axis=1)
        rate = RATE * (1 - step / (steps + 1))
        for w, a, b, g in zip(weights, first, second, _gradients(m, batch, labels)[0]):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return m


def document_probabilities(m: Model, texts: list[bytes], block: int = 2048) -> np.ndarray:
    """(texts, languages): the mean over all positions of each text."""
    windows, weights, counts = windows_of(texts)
    sums = np.empty((windows.shape[1], len(m.languages)))
    for i in range(0, len(sums), block):
        p = position_probabilities(m, windows[:, i:i + block])
        p *= weights[:, None, i:i + block]
        sums[i:i + block] = p.sum(axis=0).T
    pooled = np.zeros((len(texts), len(m.languages)))
    has = counts > 0
    if has.any():
        pooled[has] = np.add.reduceat(sums, (np.cumsum(counts) - counts)[has], axis=0)
        pooled[has] /= np.array([len(t) for t in texts])[has, None]
    return pooled


def training_sample(docs: DataFrame, usable: Column, rows: int = ROWS_PER_LANGUAGE, snippet: int = SNIPPET) -> list[tuple[str, str]]:
    """At most ``rows`` snippets of each language, of rows where ``usable``
    holds: those with the smallest hashes.  A first pass counts the
    languages, so that no task passes on more than about its share."""
    from pyspark.sql import Window

    some = docs.where(usable & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in docs.where(usable & F.col("lang").isNotNull()).groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30))
    near = reduce(lambda a, b: a | b, ((F.col("lang") == lang) & (place < int((1 << 30) * min(1.0, 3 * rows / n))) for lang, n in counts.items()))
    at = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.greatest(F.length("text") - snippet, F.lit(1))) + 1
    cut = some.where(near).select("lang", place.alias("place"), F.substring("text", at.cast("int"), snippet).alias("snippet"))
    best = cut.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("place", "snippet"))).where(F.col("nth") <= rows)
    return sorted((r["snippet"], r["lang"]) for r in best.select("snippet", "lang").collect())


def predict(docs: DataFrame, model: Model | None, block_bytes: int = 1 << 21) -> DataFrame:
    """All columns of docs plus lang_pred and score.

    Only ``text`` decides.  Null texts, and texts without any letter, are
    ``und`` with score 0 -- as is every text if nothing could be learnt; the
    score is else the pooled probability of the predicted language.  Ties go
    to the language that sorts first; repeated rows stay; other columns pass
    through, and columns already called lang_pred or score are replaced; an empty
    table stays empty.
    """
    docs = docs.drop("lang_pred", "score")
    at = docs.columns.index("text")
    flagged = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)),
                          F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            lettered = batch.column(batch.num_columns - 1).to_pylist()
            texts = [t.encode() if has else b"" for t, has in zip(batch.column(at).to_pylist(), lettered)]
            labels, scores, i = [], [], 0
            while i < len(texts):
                j, total = i, 0
                while j < len(texts) and (j == i or total + len(texts[j]) <= block_bytes):
                    total += len(texts[j])
                    j += 1
                p = document_probabilities(model, texts[i:j]) if model else np.zeros((j - i, 1))
                for t, k, v in zip(texts[i:j], p.argmax(axis=1), p.max(axis=1)):
                    known = bool(t) and model is not None
                    labels.append(model.languages[k] if known else UNKNOWN)
                    scores.append(min(1.0, float(v)) if known else 0.0)
                i = j
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                                             [*batch.schema.names[:-1], "lang_pred", "score"])

    schema = T.StructType([*(T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    out = flagged.mapInArrow(run, schema)
    return out.toDF(*docs.columns, "lang_pred", "score")


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows of ``docs`` that are not held out, predict all."""
    model = train(training_sample(docs, ~held_out(F.col("doc_id"))))
    return predict(docs, model)

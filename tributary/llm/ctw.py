"""Language-model scoring by context-tree weighting (operator 13).

A byte is coded as eight binary decisions, highest bit first.  For each
decision (``z``: a leading 1 and the bits of this byte so far) there is one
context tree whose nodes are the last 0 to ``ORDER`` bytes before it.  A node
that saw ``n0`` zeros and ``n1`` ones has a Krichevsky-Trofimov estimate; its
weighted probability is half its own estimate plus half the product of its
children's, and a prediction mixes the estimates of all depths with the
weights that training left.  A context that training never saw has no say: the
mixture ends at the deepest node seen.  Texts end with the byte 0xFF, which UTF-8
does not use, so the probabilities of all texts sum to at most one.

On Spark: documents are written, compressed, in blocks of ``BLOCK`` bytes; a task
counts the distinct grams (context and byte) and words of a block; Spark adds them
up over the corpus.  Grams are dealt by their last two context bytes and sorted, so a task
streams over whole subtrees of three bytes (at most 2**24 grams each, whatever the
corpus) and works on flat arrays; nodes of two bytes are a table that Spark sums
up and sorts in before their grams; only the two topmost levels, at most 257 * 255
nodes, meet on the driver.  The values of a block's grams and words come back to
the block by a join, so no task ever holds the model.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import written

ORDER = 5
#: Bits of a gram below its last two and its last three context bytes.
TWO, THREE = 8 * (ORDER - 1), 8 * (ORDER - 2)
#: Bytes of text that a block has at least (but for a partition's last one), that
#: are compressed together, and that arrays of positions are made for at once.
BLOCK, PACK, PIECE = 32 << 20, 4 << 20, 1 << 20
#: Rows of sorted grams that a task works on at once, but for larger subtrees.
CHUNK = 1 << 18
#: Rows that are packed into arrays of one block each at once.
ROWS = 1 << 18
PAD, END = b"\0" * ORDER, b"\xff"
#: The end of a text as a token; no word is empty.
END_TOKEN = b""


def held_out(doc_id: Column) -> Column:
    """A tenth of all documents, by the crc32 of the id as text (null: empty)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def kt_log(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of a sequence of n0 zeros and n1 ones."""
    return _lgamma(n0 + 0.5) + _lgamma(n1 + 0.5) - _lgamma(n0 + n1 + 1.0) - np.log(np.pi)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Log gamma of x > 0: Stirling's series eight places up, and back by the recurrence."""
    down = np.ones_like(x)
    for i in range(8):
        down *= np.where(x < 16, x + i, 1.0)
    y = np.where(x < 16, x + 8, x)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(down)


def weighted(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log of the weighted probability, weight of the own estimate) of inner nodes."""
    both = np.logaddexp(own, below)
    return both - np.log(2), np.exp(own - both)


def pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(owner of each run, start of each run, gram of each position) for about
    ``PIECE`` positions at a time; a long text goes over several pieces."""
    parts, owners, starts, size = [], [], [], 0
    for owner, text in enumerate(texts):
        text += END
        for lo in range(0, len(text), PIECE):
            before = text[max(0, lo - ORDER):lo].rjust(ORDER, b"\0")
            body = text[lo:lo + PIECE]
            owners.append(owner)
            starts.append(size)
            parts += [before, body]
            size += len(body)
            if size >= PIECE:
                yield np.array(owners), np.array(starts), _grams(parts)
                parts, owners, starts, size = [], [], [], 0
    if parts:
        yield np.array(owners), np.array(starts), _grams(parts)


def _grams(parts: list[bytes]) -> np.ndarray:
    """For each byte of every second part: the bytes before it, last first, and the byte, as one number."""
    a = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
    code = a[ORDER:].copy()
    for back in range(1, ORDER + 1):
        code |= a[ORDER - back:len(a) - back] << (8 * (ORDER + 1 - back))
    keep = np.ones(len(a), bool)
    at = np.cumsum([0] + [len(p) for p in parts])[:-1:2]
    keep[(at[:, None] + np.arange(ORDER)).ravel()] = False
    return code[keep[ORDER:]]


def tree_levels(gram: np.ndarray, n: np.ndarray, top: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For contexts of ORDER bytes down to ``top``: (sorted keys of context and
    byte, counts, for each row the row of the next shorter context)."""
    out, key, count = [], gram, n
    for k in range(ORDER, top, -1):
        shorter, up = np.unique((key >> 16 << 8) | (key & 255), return_inverse=True)
        out.append((key, count, up))
        key, count = shorter, np.bincount(up, count, len(shorter))
    return [*out, (key, count, np.zeros(0, np.int64))]


def nodes_of(key: np.ndarray, n: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The nodes where bit ``bit`` (0: highest) is decided: (node of each row,
    first row of each node, n0, n1)."""
    prefix = key >> (8 - bit)
    new = np.ones(len(key), bool)
    new[1:] = prefix[1:] != prefix[:-1]
    first = np.flatnonzero(new)
    node = np.cumsum(new) - 1
    one = (key >> (7 - bit)) & 1
    n1 = np.bincount(node, n * one, len(first))
    return node, first, np.bincount(node, n, len(first)) - n1, n1


def grow(levels: list, bit: int, extra: np.ndarray | None = None) -> list[dict]:
    """Weighted probabilities of one decision's nodes, deepest level first.
    ``extra``: what the children of the deepest level's nodes, outside
    ``levels``, sum up to (none: these are leaves)."""
    out, below = [], extra
    for i, (key, n, up) in enumerate(levels):
        node, first, n0, n1 = nodes_of(key, n, bit)
        own = kt_log(n0, n1)
        logp, weight = (own, np.ones(len(own))) if below is None else weighted(own, below)
        out.append({"node": node, "first": first, "n0": n0, "n1": n1, "logp": logp, "weight": weight,
                    "one": (n1 + 0.5) / (n0 + n1 + 1)})
        if len(up):
            above = nodes_of(*levels[i + 1][:2], bit)
            out[-1]["up"] = above[0][up[first]]
            below = np.bincount(out[-1]["up"], logp, len(above[1]))
    return out


def mix_down(grown: list[dict], mixed: np.ndarray, rest: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Probability of a one at the deepest level's nodes, given for the shortest
    contexts' nodes what shorter ones mixed so far, the weight they left and the
    estimate of the deepest node seen."""
    for i, g in enumerate(reversed(grown)):
        if i:
            mixed, rest, last = mixed[g["up"]], rest[g["up"]], last[g["up"]]
        seen = g["n0"] + g["n1"] > 0
        mixed, rest, last = (np.where(seen, mixed + rest * g["weight"] * g["one"], mixed),
                             np.where(seen, rest * (1 - g["weight"]), rest), np.where(seen, g["one"], last))
    return mixed + rest * last


def blocks(docs: DataFrame) -> DataFrame:
    """(block, doc_ids, held_out, sizes, texts), written: rows in blocks of at
    least ``BLOCK`` bytes, about ``PACK`` bytes of compressed text a row.  A
    document is in one block only."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    kind = rows.schema["doc_id"].dataType

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, pack, held_size = TaskContext.get().partitionId() << 32, 0, [], 0
        for batch in batches:
            types = [pa.list_(batch.schema.field("doc_id").type), pa.list_(pa.bool_()), pa.list_(pa.int64())]
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                pack.append(row)
                held_size += len(row[2])
                size += len(row[2])
                if held_size >= PACK or size >= BLOCK:
                    yield _packed(block, pack, types)
                    pack, held_size = [], 0
                    if size >= BLOCK:
                        block, size = block + 1, 0
        if pack:
            yield _packed(block, pack, types)

    schema = f"block long, doc_ids array<{kind.simpleString()}>, held_out array<boolean>, sizes array<long>, texts binary"
    return written(rows.mapInArrow(deal, schema), "ctw-docs", compression="zstd")


def _packed(block: int, rows: list[tuple], types: list) -> pa.RecordBatch:
    ids, held, texts = zip(*rows)
    data = pa.compress(b"".join(texts), codec="zstd", asbytes=True)
    return pa.RecordBatch.from_arrays([pa.array([block]), *(pa.array([list(x)], t) for x, t in zip((ids, held, map(len, texts)), types)), pa.array([data], pa.binary())],
                                      ["block", "doc_ids", "held_out", "sizes", "texts"])


def unpacked(sizes: list[int], data: bytes) -> list[bytes]:
    """The texts of one row of ``blocks``, A-Z lower-cased."""
    whole = pa.decompress(data, decompressed_size=sum(sizes), codec="zstd", asbytes=True).lower() if sum(sizes) else b""
    ends = np.cumsum([0, *sizes]).tolist()
    return [whole[lo:hi] for lo, hi in zip(ends, ends[1:])]


COUNTS = "block long, gram long, word binary, n long"


class _Block:
    """Distinct grams and words of a block, with their counts in training documents."""

    def __init__(self):
        self.found, self.counts, self.words = [np.zeros(0, np.int64)], [np.zeros(0)], Counter()

    def add(self, held: list[bool], texts: list[bytes]) -> None:
        for unit in (1, 0):
            of = [t for t, h in zip(texts, held) if h == (not unit)]
            for _, _, grams in pieces(of):
                at, names = pd.factorize(grams)
                self.found.append(names)
                self.counts.append(unit * np.bincount(at, minlength=len(names)))
            for text in of:
                if unit:
                    self.words.update(text.split())
                    self.words[END_TOKEN] += 1
                else:
                    for word in text.split():
                        self.words.setdefault(word, 0)
        self.merge()

    def merge(self) -> None:
        at, names = pd.factorize(np.concatenate(self.found))
        self.found, self.counts = [names], [np.bincount(at, np.concatenate(self.counts), len(names))]

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        grams, words = np.sort(self.found[0]), list(self.words)
        n = self.counts[0][np.argsort(self.found[0])].astype(np.int64)
        for grams, words, of in ((grams, None, n), (None, words, list(self.words.values()))):
            size = len(of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, block)), pa.nulls(size, pa.int64()) if grams is None else pa.array(grams),
                 pa.nulls(size, pa.binary()) if words is None else pa.array(words, pa.binary()), pa.array(of, pa.int64())],
                ["block", "gram", "word", "n"])


def count_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every distinct gram and word of a block (of a part of it, where a block's
    rows are read by several tasks)."""
    now, counts = None, None
    for batch in batches:
        for block, held, sizes, data in zip(*(batch.column(c).to_pylist() for c in ("block", "held_out", "sizes", "texts"))):
            if block != now:
                if now is not None:
                    yield from counts.rows(now)
                now, counts = block, _Block()
            counts.add(held, unpacked(sizes, data))
    if now is not None:
        yield from counts.rows(now)


def above(key: np.ndarray, bit: int) -> np.ndarray:
    """For nodes where ``bit`` is decided, given by a key of context and byte:
    the node of the next shorter context, as context * 256 + decision."""
    return (key >> 16 << 8) | (1 << bit) | ((key & 255) >> (8 - bit))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """From sorted rows (gram, n, node, mixed, rest, last), a gram's or a node's:
    (grams, counts, nodes' rows with the node first), about CHUNK grams at a time,
    cut only between grams that differ in their last three context bytes.  The
    rows of a gram's node of two bytes come along."""
    grams, counts, nodes = np.zeros(0, np.int64), np.zeros(0), np.zeros((4, 0))
    parts, size = [], 0

    def joined():
        rows = pa.Table.from_batches(parts)
        is_gram = rows.column("gram").is_valid()
        g, x = rows.filter(is_gram), rows.filter(pa.compute.invert(is_gram))
        return (np.concatenate([grams, g.column("gram").to_numpy()]), np.concatenate([counts, g.column("n").to_numpy().astype(float)]),
                np.concatenate([nodes, np.stack([x.column(c).to_numpy().astype(float) for c in ("node", "mixed", "rest", "last")])], axis=1))

    for batch in batches:
        parts.append(batch)
        size += batch.num_rows
        if size >= CHUNK:
            grams, counts, nodes = joined()
            parts, size = [], 0
            cut = int(np.searchsorted(grams, grams[-1] >> THREE << THREE)) if len(grams) else 0
            if cut:
                yield grams[:cut], counts[:cut], nodes
                nodes = nodes[:, nodes[0] >= grams[cut] >> TWO << 8]
                grams, counts = grams[cut:], counts[cut:]
    if parts:
        grams, counts, nodes = joined()
    if len(grams):
        yield grams, counts, nodes


def grow_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the nodes with contexts of three bytes, by their parent: n0, n1
    and log of the weighted probabilities."""
    for gram, n, _ in _batches(batches):
        levels = tree_levels(gram, n, 3)
        for bit in range(8):
            g = grow(levels, bit)[-1]
            of, at = np.unique(above(levels[-1][0][g["first"]], bit), return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(of), *(pa.array(np.bincount(at, g[c], len(of))) for c in ("n0", "n1", "logp"))], ["node", "n0", "n1", "below"])


def weigh_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes with their sums -> (node, n0, n1, logp, weight)."""
    for batch in batches:
        n0, n1, below = (batch.column(c).to_numpy() for c in ("n0", "n1", "below"))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *map(pa.array, weighted(kt_log(n0, n1), below))], ["node", "n0", "n1", "logp", "weight"])


def _mix(mixed, rest, last, n0, n1, weight):
    seen, one = n0 + n1 > 0, (n1 + 0.5) / (n0 + n1 + 1)
    return np.stack([np.where(seen, mixed + rest * weight * one, mixed), np.where(seen, rest * (1 - weight), rest), np.where(seen, one, last)])


def top_levels(nodes: pd.DataFrame) -> np.ndarray:
    """From at most 256 * 255 sums by (last byte, decision): for each (last byte *
    256 + decision) what the two topmost levels mix, leave and estimate last."""
    n0, n1, below = (np.bincount(nodes["node"].to_numpy(np.int64), nodes[c].to_numpy(float), 1 << 16) for c in ("n0", "n1", "below"))
    logp, weight = weighted(kt_log(n0, n1), below)
    r0, r1, rb = (x.reshape(256, 256).sum(0) for x in (n0, n1, logp))
    root = _mix(np.zeros(256), np.ones(256), np.full(256, 0.5), r0, r1, weighted(kt_log(r0, r1), rb)[1])
    return _mix(*np.tile(root, (1, 256)), n0, n1, weight)


def mix_nodes(top: np.ndarray):
    """A task's function: nodes of two bytes -> (node, mixed, rest, last)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, n0, n1, weight = (batch.column(c).to_numpy() for c in ("node", "n0", "n1", "weight"))
            found = _mix(*top[:, (node >> 16 << 8) | (node & 255)], n0, n1, weight)
            yield pa.RecordBatch.from_arrays([batch.column("node"), *map(pa.array, found)], ["node", "mixed", "rest", "last"])
    return run


def predict_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """log10 of the probability of each gram's last byte after its context."""
    for gram, n, nodes in _batches(batches):
        levels, total = tree_levels(gram, n, 3), np.zeros(len(gram))
        order = np.argsort(nodes[0])
        names, given = nodes[0][order].astype(np.int64), nodes[1:, order]
        for bit in range(8):
            grown = grow(levels, bit)
            at = np.searchsorted(names, above(levels[-1][0][grown[-1]["first"]], bit))
            one = mix_down(grown, *given[:, at])[grown[0]["node"]]
            total += np.log10(np.where((gram >> (7 - bit)) & 1 == 1, one, 1 - one))
        yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(total)], ["gram", "value"])


PACKS = "block long, grams binary, logs binary, words binary, counts binary"


def pack_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, gram, value) or (block, word, n) -> packed arrays of about ``ROWS`` rows, a block each."""
    def packs(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        block = rows.column("block").to_numpy()
        order = np.argsort(block, kind="stable")
        runs = np.split(order, np.flatnonzero(np.diff(block[order])) + 1)
        if "word" in rows.column_names:
            word, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
            of = [(int(block[r[0]]), None, None, b" ".join([word[i] for i in r]), n[r].tobytes()) for r in runs]
        else:
            gram, value = rows.column("gram").to_numpy(), rows.column("value").to_numpy()
            of = [(int(block[r[0]]), gram[r].tobytes(), value[r].tobytes(), None, None) for r in runs]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i == 0 else pa.binary()) for i, c in enumerate(zip(*of))],
                                          ["block", "grams", "logs", "words", "counts"])
    parts, size = [], 0
    for batch in batches:
        if batch.num_rows:
            parts.append(batch)
            size += batch.num_rows
        if size >= ROWS:
            yield packs(parts)
            parts, size = [], 0
    if parts:
        yield packs(parts)


def score_block(least: float):
    """A task's function: token counts and scores of a block's documents from the
    values of its grams and the counts of its words (``least``: log10 of the base's denominator)."""
    def run(docs: pa.Table, values: pa.Table) -> pa.Table:
        packs = {c: [x for x in values.column(c).to_pylist() if x is not None] for c in ("grams", "logs", "words", "counts")}
        place = {w: i for i, w in enumerate(b" ".join(packs["words"]).split(b" "))}
        counts = np.frombuffer(b"".join(packs["counts"]), np.int64)
        # a word that came twice has its last place
        worth = np.log10(counts + 0.1) - least
        grams, logs = np.frombuffer(b"".join(packs["grams"]), np.int64), np.frombuffer(b"".join(packs["logs"]), float)
        order = np.argsort(grams)
        grams, logs = grams[order], logs[order]
        del packs, order
        ids, held, n_tokens, n_known, base, scores = [], [], [], [], [], []
        for row in range(docs.num_rows):
            texts = unpacked(docs.column("sizes")[row].as_py(), docs.column("texts")[row].as_py())
            score = np.zeros(len(texts))
            for owners, starts, codes in pieces(texts):
                at, names = pd.factorize(codes)
                np.add.at(score, owners, np.add.reduceat(logs[np.searchsorted(grams, names)][at], starts))
            scores.append(score)
            ids.append(docs.column("doc_ids")[row].values)
            held.append(docs.column("held_out")[row].values)
            for text in texts:
                of = np.array([place[w] for w in text.split()], np.int64)
                n_tokens.append(len(of) + 1)
                n_known.append(np.count_nonzero(counts[of]))
                base.append(worth[of].sum())
        return pa.table({"doc_id": pa.concat_arrays(ids), "held_out": pa.concat_arrays(held), "n_tokens": pa.array(n_tokens, pa.int64()),
                         "n_known": pa.array(n_known, pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(np.concatenate(scores))})
    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    The model learns from all rows whose id is not held out.  ``score`` is its
    log10 probability of the whole text (A-Z lower-cased, as UTF-8, with its
    end); -score * log2(10) / bytes is the code length a byte.  ``base_score``
    is that of single words with 0.1 added to each count.  A null text is an
    empty one (one token, its end); a null id counts as empty text; repeated
    rows are scored, and learnt from, each; an empty table gives no row; columns
    other than doc_id and text are not looked at.  Without training documents
    every decision has probability one half.
    """
    spark = docs.sparkSession
    rows = blocks(docs)
    counts = written(rows.drop("doc_ids").mapInArrow(count_blocks, COUNTS), "ctw-counts", compression="zstd")

    grams = written(counts.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("n").alias("n")), "ctw-grams")
    none = [F.lit(None).cast("long").alias("node"), *(F.lit(None).cast("double").alias(c) for c in ("mixed", "rest", "last"))]
    leaves = grams.select("gram", "n", *none)
    dealt = leaves.repartition(F.shiftright("gram", TWO)).sortWithinPartitions("gram")
    sums = [F.sum(c).alias(c) for c in ("n0", "n1", "below")]
    nodes = dealt.mapInArrow(grow_subtrees, "node long, n0 double, n1 double, below double").groupBy("node").agg(*sums)
    nodes = written(nodes.mapInArrow(weigh_nodes, "node long, n0 double, n1 double, logp double, weight double"), "ctw-nodes")
    parents = nodes.select(F.expr("shiftleft(shiftright(node, 16), 8) | (node & 255)").alias("node"), "n0", "n1", F.col("logp").alias("below"))
    top = top_levels(parents.groupBy("node").agg(*sums).toPandas())  # at most 256 * 255 rows
    nodes = nodes.select("node", "n0", "n1", "weight").mapInArrow(mix_nodes(top), "node long, mixed double, rest double, last double")
    rows_of = leaves.unionByName(nodes.select(F.lit(None).cast("long").alias("gram"), F.lit(None).cast("long").alias("n"), "*"))
    pair = F.coalesce(F.shiftright("gram", TWO), F.shiftright("node", 8))
    logs = (rows_of.withColumn("pair", pair).repartition("pair").sortWithinPartitions("pair", F.col("gram").asc_nulls_first())
            .drop("pair").mapInArrow(predict_grams, "gram long, value double"))

    # a block has a word once (or once a part), so no word has many rows
    of_word = Window.partitionBy("word")
    words = written(counts.where("word IS NOT NULL").select(
        "block", "word", F.sum("n").over(of_word).alias("n"), (F.row_number().over(of_word.orderBy("block")) == 1).alias("first")), "ctw-words", compression="zstd")
    total = words.where("first").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("v"),
        F.coalesce(F.max(F.when(F.col("word") == END_TOKEN, F.col("n"))), F.lit(0)).alias("ends")).first()
    least = float(np.log10(total["n"] + 0.1 * (total["v"] + 1)))

    values = (counts.where("gram IS NOT NULL").select("block", "gram").join(logs, "gram").mapInArrow(pack_values, PACKS)
              .unionByName(words.where(F.col("word") != END_TOKEN).select("block", "word", "n").mapInArrow(pack_values, PACKS)))
    end = float(np.log10(total["ends"] + 0.1) - least)
    kind = rows.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    found = rows.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(score_block(least), schema)
    return found.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + int(total["ends"] > 0)).alias("n_known"),
                        F.lit(int(total["n"])).cast("long").alias("train_tokens"), (F.col("base_score") + end).alias("base_score"), "score")

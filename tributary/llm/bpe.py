"""Byte-level BPE encoding and decoding with segment trees.

A pre-token is a row of symbols.  Over its adjacent pairs stands a segment
tree whose leaves hold ``rank * size + place`` of the pair (or nothing), so the
root is always the leftmost pair of the lowest rank.  A merge changes three
leaves -- its own, its left neighbour's and the one it swallowed -- and the
three paths to the root; merging goes on until the root is empty.  Many
pre-tokens of one size are kept as the rows of one numpy array, so every step
works on all that still have something to merge.

Each task reads the vocabulary file once and remembers the ids of the
pre-tokens it met, within a fixed bound.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed value: how the vocabulary's pre-tokenizer cuts text.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Leaves that are held at a time, and chunks a worker remembers (two generations of these).
CELLS, REMEMBERED = 1 << 16, 500_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies:
    printable Latin-1 as itself, the others from U+0100 on in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        import regex

        spec = json.loads(open(path, encoding="utf-8").read())
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        self.width = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        self.byte_ids = np.array([vocab[c] for c in letters], dtype=np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(of_letter[c] for c in s) for s, i in vocab.items() if s not in self.special}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.bytes_of_decimal = {str(i): b for i, b in self.bytes_of.items()}
        self.cut = regex.compile(PRETOKEN).findall
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        alone = np.arange(256, dtype=np.int32)
        left, right = self.byte_ids[alone][:, None], self.byte_ids[alone][None, :]
        self.byte_pairs = self.rank_of(np.broadcast_to(left, (256, 256)), np.broadcast_to(right, (256, 256)))
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}

    # -- merging ----------------------------------------------------------

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each adjacent pair; -1 where it cannot merge."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], -1)

    def leaves(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
        rank = self.rank_of(left, right)
        return np.where(rank >= 0, rank * size + place, self.nothing(size))

    def nothing(self, size: int) -> int:
        """More than any leaf: an empty one."""
        return len(self.keys) * size

    def merge(self, words: list[bytes], size: int) -> list[tuple[int, ...]]:
        """Ids of words of at most ``size`` (a power of two) bytes each."""
        n = len(words)
        lens = np.fromiter(map(len, words), dtype=np.int64, count=n)
        inside = np.arange(size) < lens[:, None]
        sym = np.full((n, size + 1), -1, dtype=np.int32)  # the last column ends every row
        raw = np.zeros((n, size + 1), dtype=np.uint8)
        raw[:, :size][inside] = np.frombuffer(b"".join(words), dtype=np.uint8)
        sym[:, :size][inside] = self.byte_ids[raw[:, :size][inside]]
        after = np.tile(np.arange(1, size + 2, dtype=np.int32), (n, 1))
        before = np.tile(np.arange(-1, size, dtype=np.int32), (n, 1))
        none = self.nothing(size)
        tree = np.full((n, 2 * size), none, dtype=np.int32 if none < 1 << 31 else np.int64)
        rank = np.where(np.arange(1, size + 1) < lens[:, None], self.byte_pairs[raw[:, :-1], raw[:, 1:]], -1)
        tree[:, size:] = np.where(rank >= 0, rank * size + np.arange(size), none)
        half = size
        while half > 1:
            half //= 2
            tree[:, half:2 * half] = np.minimum(tree[:, 2 * half:4 * half:2], tree[:, 2 * half + 1:4 * half:2])
        row = np.flatnonzero(tree[:, 1] != none)
        while len(row):
            rank, at = np.divmod(tree[row, 1], size)
            gone = after[row, at]
            then = after[row, gone]
            sym[row, at], sym[row, gone] = self.made[rank], -1
            after[row, at] = then
            before[row, np.minimum(then, size)] = at
            prev = before[row, at]
            tree[row, size + gone] = none
            tree[row, size + at] = self.leaves(sym[row, at], sym[row, np.minimum(then, size)], at, size)
            has = prev >= 0
            r, p = row[has], prev[has]
            tree[r, size + p] = self.leaves(sym[r, p], sym[r, at[has]], p, size)
            for r, leaf in ((row, gone), (row, at), (r, p)):
                node = size + leaf.astype(np.int64)
                while size > 1 and len(r) and node[0] > 1:
                    node >>= 1
                    tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
            row = row[tree[row, 1] != none]
        kept = sym >= 0
        flat, ends = sym[kept].tolist(), np.cumsum(kept.sum(axis=1)).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends[:-1]], ends)]

    def learn(self, tokens: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Ids of distinct pre-tokens."""
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for t in tokens:
            b = t.encode()
            by_size.setdefault(1 << max(0, len(b) - 1).bit_length(), []).append((t, b))
        out = {}
        for size, group in by_size.items():
            step = max(1, CELLS // size)
            for i in range(0, len(group), step):
                part = group[i:i + step]
                out.update(zip((t for t, _ in part), self.merge([b for _, b in part], size)))
        return out

    # -- texts ------------------------------------------------------------

    def cuts(self, text: str) -> list[str]:
        """Pre-tokens; strings of special tokens come as they are."""
        if self.marks is None or not any(s in text for s in self.special):
            return self.cut(text)
        return [t for part in self.marks.split(text) if part
                for t in ([part] if part in self.special else self.cut(part))]

    def chunks(self, text: str) -> list[str]:
        """``text`` cut at places where a pre-token always ends: before a
        lone space or line feed.  Where white space comes in runs, at an end, or is
        of another kind, it is one chunk."""
        words, lone = text.split(), text.count(" ") + text.count("\n")
        # no other white space, and so many words that none of it is in a row or at an end
        if len(text) - len("".join(words)) != lone or len(words) != lone + 1 or any(s in text for s in self.special):
            return [text]
        first, *rest = text.replace("\n", " \n").split(" ")
        return [first, *(r if r[0] == "\n" else " " + r for r in rest)]

    def pretokens(self, chunk: str) -> list[str]:
        """``cuts`` of a chunk; a word, or a word and a mark, without the pattern."""
        word = chunk[1:] if chunk[:1] == " " else chunk
        if word.isalpha():
            return [chunk]
        if chunk[-1:] in (".", ",", ";", ":", "!", "?") and word[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self.cuts(chunk)

    def recall(self, chunk_lists: list[list[str]]) -> dict[str, str]:
        """For every chunk its ids, as decimals joined by commas."""
        here: dict[str, str] = {}
        young, old, lost = self.young, self.old, []
        for chunk in set(chain.from_iterable(chunk_lists)):
            if (e := young.get(chunk)) is None and (e := old.get(chunk)) is None:
                lost.append(chunk)
            else:
                here[chunk] = e
        cuts = list(map(self.pretokens, lost))
        ids_of = self.learn({*chain.from_iterable(cuts)} - self.special.keys())
        ids_of |= {s: (i,) for s, i in self.special.items()}
        decimals = {t: ",".join(map(str, ids)) for t, ids in ids_of.items()}
        for chunk, ts in zip(lost, cuts):
            here[chunk] = decimals[ts[0]] if len(ts) == 1 else ",".join(map(decimals.__getitem__, ts))
        if len(young) + len(here) > REMEMBERED:
            self.old, self.young = young, {}
        self.young.update((c, e) for c, e in here.items() if len(c) <= 64)
        return here

    def decimals(self, texts: list[str], chars: int = 1 << 21) -> Iterator[str]:
        """The ids of each text, as decimals joined by commas; the unknown
        pre-tokens of about ``chars`` characters of text are merged together."""
        i = 0
        while i < len(texts):
            j, total = i, 0
            while j < len(texts) and (j == i or total + len(texts[j]) <= chars):
                total += len(texts[j])
                j += 1
            lists = [self.chunks(t) for t in texts[i:j]]
            here = self.recall(lists)
            for parts in lists:
                yield ",".join(map(here.__getitem__, parts)) if parts != [""] else ""
            i = j

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text, in order."""
        for ids in self.decimals(texts):
            yield list(map(int, ids.split(","))) if ids else []

    def decode(self, ids: Iterable[int]) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")

    def decode_decimals(self, ids: str) -> str:
        return b"".join(map(self.bytes_of_decimal.__getitem__, ids.split(","))).decode("utf-8", errors="replace") if ids else ""


_LOADED: dict[str, Bpe] = {}


def bpe(path: str) -> Bpe:
    """The vocabulary's encoder, read once by each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_tokens, ids_sha256 and
    decoded_sha256 -- the text is encoded whole, its ids decoded again.

    Null text counts as empty (no ids); other columns are ignored; repeated
    rows and null doc_ids keep their rows; an empty table gives none.
    """
    def run(batches):
        import pyarrow as pa

        coder = bpe(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts, ids_hash, text_hash = [], [], []
            for ids in coder.decimals(texts):
                counts.append(ids.count(",") + bool(ids))
                ids_hash.append(hashlib.sha256(ids.encode()).hexdigest())
                text_hash.append(hashlib.sha256(coder.decode_decimals(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)

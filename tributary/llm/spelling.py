"""Spelling variant grouping by asymmetric q-chunks (operator 11).

Words are near if they differ by exactly one inserted, deleted or replaced
code point.  Of two such words the shorter (either, if equally long) has two
disjoint chunks, its halves; one edit preserves one of them.  The other word has
positional grams of the chunks' lengths; a preserved chunk stands at most one
place further on, at the shift that the lengths leave: its own place before
the edit, the difference of lengths after it.  So place and shift are part of
the join key, grams that no single edit can have moved are never made, and
what joins is verified.

A chunk that many words share would pair them all.  What is left of the words outside
a shared chunk (a *window*) again differs by one edit, so a large group is split by the
chunks of its windows, again and again, until groups are small or their windows
hold one code point (two in the longer word).  With the 90 letters there are, such a
group has at most 90 shorter words, all near each other, and 90 * 90 longer ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import written

#: Pairs that a group may have to be compared whole.
PAIRS = 1 << 12
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, least_length: int = 7, least_count: int = 2, every: int = 31) -> DataFrame:
    """(word, n): maximal runs of letters, A-Z lower-cased.  Of a run whose crc32
    with the document's id is divisible by ``every``, the code point at that
    number modulo the length is deleted first.  Null texts have no words; a null
    id counts as empty text; repeated rows count each."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(h, F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(h % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _windows(rows: DataFrame) -> DataFrame:
    """Each row's window [lo, hi) of the shorter word split in its halves: the key
    is all that lies outside the new window, of both chunks so far."""
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.array(F.struct("lo", mid.alias("hi")), F.struct(mid.alias("lo"), "hi"))
    out = rows.select("word", "n", "longer", F.explode(halves).alias("w")).select("word", "n", "longer", "w.lo", "w.hi")
    # the window of the longer word has one code point more
    rest = F.substring("word", F.col("hi") + F.col("longer") + 1, F.length("word"))
    return out.withColumn("length", F.length("word") - F.col("longer")).withColumn(
        "outside", F.concat(F.substring("word", F.lit(1), F.col("lo")), rest))


GROUP = ["length", "lo", "hi", "outside"]


def near_pairs(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(a, n_a, b, n_b) of distinct near words of (word, n), each pair once with
    the shorter, or else smaller, word as ``a``.

    Each word comes as the side with the chunks (``longer`` 0) and, with one code
    point more than that, as the side with the grams (``longer`` 1); words of one
    length meet within side 0.  A round writes the groups that are too
    large, split further; there are at most log2(longest word) rounds.
    """
    base = words.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("longer"), F.lit(0).alias("lo")).withColumn(
        "hi", F.length("word") - F.col("longer"))
    rows, found = written(_windows(base), "spelling-windows"), []
    while True:
        size = rows.groupBy(*GROUP).agg(F.sum(1 - F.col("longer")).alias("short"), F.sum("longer").alias("long"))
        size = size.withColumn("pairs", F.col("short") * (F.col("short") + F.col("long")))
        # a single code point can't be split
        large = written(size.where((F.col("pairs") > pairs) & (F.col("hi") - F.col("lo") > 1)).select(*GROUP, F.lit(True).alias("large")), "spelling-large")
        meeting = size.where((F.col("short") > 0) & (F.col("short") + F.col("long") > 1)).select(*GROUP)
        small = rows.join(large, GROUP, "left_anti").join(meeting, GROUP, "left_semi")
        a = small.where("longer = 0").select(*GROUP, F.col("word").alias("a"), F.col("n").alias("n_a"))
        b = small.select(*GROUP, F.col("word").alias("b"), F.col("n").alias("n_b"), "longer")
        met = a.join(b, GROUP).where((F.col("longer") == 1) | (F.col("a") < F.col("b")))
        found.append(written(met.where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b"), "spelling-pairs"))
        if large.isEmpty():
            break
        split = rows.join(large, GROUP, "left_semi").select("word", "n", "longer", "lo", "hi")
        rows = written(_windows(split), "spelling-windows")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def group_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of (word, n).

    A word's form is its near word of largest n, the smallest in code-point order
    among equals, if that n is at least ``ratio`` times the word's; ``root`` is where
    forms lead to.  Each step multiplies n, so there are few; the steps
    double in length with every round.  No words, no rows.
    """
    words = written(words, "spelling-words")
    near = written(near_pairs(words), "spelling-near")
    both = near.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionByName(
        near.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("m"), F.col("other"))).alias("best"))
    top = -F.col("best.col1")
    has = top >= ratio * F.col("n")
    forms = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has, F.col("best.other")).alias("form"), F.when(has, top).alias("form_n")), "spelling-forms")
    to = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(to.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        to = step.drop("moved")
        if step.where("moved").isEmpty():
            break
    return forms.join(to, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

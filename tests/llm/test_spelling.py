import random
import re
import zlib
from collections import Counter

from tributary.llm import spelling
from tributary.llm.queries import op11_spelling_variants

SF_SMALL = "/root/testdata/sf0.001"


def counted(rows):
    """Words as the contract has them, in plain Python."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(n):
    out, form, shapes = {}, {}, {}
    for w in n:  # words that lose one code point to the same string, or are that string
        for i in range(len(w)):
            shapes.setdefault(w[:i] + w[i + 1:], set()).add(w)
        shapes.setdefault(w, set()).add(w)
    for w in n:
        of = set().union(shapes[w], *(shapes[w[:i] + w[i + 1:]] for i in range(len(w))))
        of = sorted(((-n[x], x) for x in of if x != w and near(w, x)))
        form[w] = of[0][1] if of and -of[0][0] >= 10 * n[w] else None
        out[w] = (len(of), form[w] and n[form[w]])
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], *out[w])
    return out


def got(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    n = counted([(r[0], r[1]) for r in docs])
    assert got(op11_spelling_variants(spark, SF_SMALL)) == expected(n)


def words(spark, n):
    return spark.createDataFrame(list(n.items()), "word string, n long")


def test_near_pairs_of_random_words(spark):
    rng = random.Random(5)
    for alphabet, sizes in (("ab", (7, 10)), ("abcé", (7, 8)), ("abcdefgh", (7, 16))):
        n = {"".join(rng.choice(alphabet) for _ in range(rng.randint(*sizes))): rng.choice([2, 3, 25, 400]) for _ in range(400)}
        pairs = {frozenset((r["a"], r["b"])) for r in spelling.near_pairs(words(spark, n), pairs=8).collect()}
        assert pairs == {frozenset((a, b)) for a in n for b in n if near(a, b)}


def test_large_groups_are_split_without_loss(spark):
    """One half is common to all words; groups of it, and of what is left, are far
    above the limit."""
    rng = random.Random(9)
    n = {"international" + "".join(rng.choice("abcdefghij") for _ in range(rng.randint(5, 7))): 2 for _ in range(1500)}
    for w in list(n)[:300]:
        i = rng.randrange(len(w) + 1)
        n[rng.choice([w[:i] + "z" + w[i:], w[:i - 1] + "z" + w[i:]]) if i else "z" + w] = 20
    assert got(spelling.group_variants(words(spark, n))) == expected(n)


def test_form_ties_and_chains(spark):
    n = {"letters": 2000, "lettars": 200, "lettaro": 20, "lettxro": 2, "bettors": 40, "bettars": 40, "bettbrs": 4, "settars": 2000}
    out = got(spelling.group_variants(words(spark, n)))
    assert out == expected(n)
    assert out["lettars"][0] == "letters" and out["lettxro"][1] == "letters"  # the smaller of two, four steps
    assert out["bettbrs"][0] == "bettars"


def test_words_of_texts(spark):
    rows = [(1, "ABCDEFGH abcdefgh abcdefgh×xÿyzabcd", "x"), (None, "abcdefgh ABCDEFGÉ abcdefgé", "x"), (2, None, "x"), (3, "", "x"),
            (4, "a" * 300_000 + " " + "a" * 300_000, "x"), (5, "\U0001f926abcdefgh\U0001f926 abcdefgh", "x"), (5, "\U0001f926abcdefgh\U0001f926 abcdefgh", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    n = counted([r[:2] for r in rows])
    assert {r["word"]: r["n"] for r in spelling.word_counts(docs).collect()} == n
    assert got(spelling.group_variants(spelling.word_counts(docs))) == expected(n)


def test_no_words(spark):
    assert spelling.group_variants(spelling.word_counts(spark.createDataFrame([], "doc_id long, text string"))).count() == 0

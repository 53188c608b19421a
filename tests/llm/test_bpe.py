import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tributary.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
ODD = ["", " ", "\n", "a", " a", "a ", "\na", "a\n\nb  c", "<|endoftext|>", "x<|endoftext|> y<|endoftext|><|endoftext|>z", "<|endoftext", "é" * 400,
       "it's we'LL 12 ٣٤ 你好 🤦🏼‍♂️", "\x1c \x85　q", "ab" * 3000, "word. Word, (word)! \"w\"", "\0�",
       "Done. Next\tcell", "Done.  Next\tcell", "a\n\n\nb\tc\td", " Hello\xa0world", "x  y\u3000z", "a\u2028b  c", "tail \xa0x", "a \nb\x1fc", "\xa0a b ", "one two\nthree"]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def test_ids_and_texts_are_the_tokenizers_own(reference):
    coder = bpe.Bpe(PATH)
    for _ in range(2):  # the second time everything is remembered
        got = list(coder.encode(ODD))
        want = [e.ids for e in reference.encode_batch(ODD, add_special_tokens=False)]
        assert got == want
        assert [coder.decode(i) for i in got] == [reference.decode(i, skip_special_tokens=False) for i in want] == ODD
    assert coder.decode(got[11][:1]) == reference.decode(got[11][:1], skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    coder, ref = bpe.bpe(PATH), Tokenizer.from_file(PATH) if not hasattr(test_any_text, "ref") else test_any_text.ref
    test_any_text.ref = ref
    (ids,) = coder.encode([text])
    assert ids == ref.encode(text, add_special_tokens=False).ids and coder.decode(ids) == text


def test_small_memory_gives_the_same(monkeypatch, reference):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    texts = [f"word{i % 7} other{i}. again" for i in range(50)]
    assert list(bpe.Bpe(PATH).encode(texts)) == [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]


def test_query_rows(spark, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1, None), (None, "x y"), (-1, None)], "doc_id long, text string"))
    got = sorted(map(tuple, bpe.encode_decode(docs, PATH).collect()), key=str)
    want = []
    for r in docs.collect():
        ids = reference.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.encode_decode(docs.limit(0), PATH).count() == 0

"""Ids and texts against the tokenizers library."""

import json

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from devicepulse.llm import bpe
from devicepulse.llm.text_queries import bpe_digests

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as f:
    SPEC = json.load(f)
CODER, TEXTS = bpe.Vocabulary(SPEC), bpe.TokenBytes(SPEC)

ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\n", "it's'll'", "x" * 5000, "ab" * 3000]
ODD += [" " * 3000, "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "日本語テキスト", "🎉🎉 é́", "\x1c\x85\xa0 a"]


def same(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert CODER.encode(text) == ids
    assert TEXTS.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False) == text


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    same(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "th", "ing", "'s", " ", "  ", "\n", "0", "é", "日", "--", "<|endoftext|>", "aaa"])))
def test_mixed_parts(parts):
    same("".join(parts))


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    same(text)


def test_every_code_point_is_cut_as_by_the_library():
    for start in range(0, 0x30000, 64):
        points = [c for c in range(start, start + 64) if not 0xD800 <= c < 0xE000]
        text = "".join("a" + chr(c) + " " + chr(c) * 2 + "1" for c in points)
        assert CODER.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_broken_bytes_become_replacement_characters():
    ids = LIBRARY.encode("日", add_special_tokens=False).ids[:1]
    assert TEXTS.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_broken_bytes_in_a_batch(spark):
    first = LIBRARY.encode("日", add_special_tokens=False).ids
    lists = [first[:1], first[1:], [], None, first, [50256]]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "n int, ids array<int>").coalesce(1)
    got = {r.n: r.text for r in bpe.decode(docs, bpe.load(docs, PATH)).collect()}
    assert got == {i: LIBRARY.decode(x or [], skip_special_tokens=False) for i, x in enumerate(lists)}


def test_unknown_ids_raise():
    with pytest.raises(ValueError, match="vocabulary"):
        TEXTS.decode([60000])


def test_full_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    small = bpe.Vocabulary(SPEC)
    for text in ("the cat sat on the mat and the dog", "one two three four five six"):
        assert small.encode(text) == CODER.encode(text)


def test_rows_keep_their_columns(spark):
    rows = [(1, "the cat", "x"), (1, "the cat", "x"), (None, None, None), (2, "", "y"), (3, "word " * 30000, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string").repartition(3)
    vocabulary = bpe.load(docs, PATH)
    ids = bpe.encode(docs, vocabulary)
    assert ids.columns == ["doc_id", "ids"]
    back = {(r.doc_id, r.text) for r in bpe.decode(ids, vocabulary).collect()}
    assert back == {(i, t or "") for i, t, _ in rows} and ids.count() == 5
    digests = {r.doc_id: r for r in bpe_digests(docs, vocabulary).collect()}
    assert digests[None].n_tokens == 0 and digests[3].n_tokens == len(CODER.encode(rows[4][1]))
    assert bpe_digests(docs.limit(0), vocabulary).collect() == []


def test_decoding_in_the_same_pass(spark):
    rows = [(1, "one two  three é\U0001f600"), (2, None), (3, ""), (1, "again and again"), (None, " ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    shared = bpe.load(docs, PATH)
    both = bpe.encode(docs, shared, decoded="decoded")
    assert both.columns == ["doc_id", "ids", "decoded"]
    apart = bpe.decode(bpe.encode(docs, shared), shared)
    assert sorted(map(str, both.select("doc_id", "decoded").collect())) == sorted(
        map(str, apart.withColumnRenamed("text", "decoded").collect())
    )
    # One pass over the texts, not two with workers of their own.
    plan = bpe_digests(docs, shared)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1

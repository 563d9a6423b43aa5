"""The stages one after another against their operators' brute-force versions, and odd tables."""

import hashlib
import json
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from devicepulse.llm import personal_data

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def clean(k, n=80):
    return " ".join(f"word{k}x{i}" for i in range(n))


def rows():
    base = clean(1)
    made = [
        (1, base, "en", "a"),
        (2, base, "en", "b"),
        (3, base + " tail", "en", "a"),
        (4, clean(4) + " write to some.one@mail.example.com now", "en", "b"),
        (5, clean(5, 200), "de", "a"),
        (6, clean(6).upper().replace(" ", "!! "), "en", "a"),
        (7, "too short", "en", "c"),
        (8, None, None, None),
        (9, clean(9, 120), None, None),
        (9, clean(9, 120), None, None),
        (None, clean(10), "fr", "c"),
    ]
    return [(i, t, lang, s, len(t) if t else None) for i, t, lang, s in made]


def staged(spark, docs):
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, None)
        out[name] = docs.collect()
        if out[name]:
            docs = spark.createDataFrame(out[name], docs.schema)
        else:
            docs = spark.createDataFrame([], docs.schema)
    return out


def test_each_stage_does_its_work(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    done = staged(spark, docs)
    names = [n for n, _ in corpus_pipeline.STAGES]
    ids = {n: Counter(r.doc_id for r in done[n]) for n in names}
    assert ids[names[0]] == Counter([1, 2, 3, 4, 5, 9, 9, None])
    assert ids[names[1]] == Counter([1, 4, 5, 9, None])
    texts = {r.doc_id: r.text for r in done[names[2]]}
    assert "<email>" in texts[4] and "@" not in texts[4] and texts[5] == clean(5, 200)
    assert all(len(r.text) == r.n_chars for r in done[names[2]] + done[names[3]])
    taken = sum(len(r.text.split()) for r in done[names[3]])
    total = sum(len(t.split()) for t in texts.values())
    assert abs(taken - total) <= 0.2 * total
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in done[names[3]]:
        made = library.encode(r.text, add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, made)).encode()).hexdigest()
        want[r.doc_id, len(made), digest, hashlib.sha256(r.text.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in done[names[4]]) == want


def test_run_equals_the_stages(spark, tmp_path):
    docs = spark.createDataFrame(rows(), SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    last = corpus_pipeline.STAGES[-1][0]
    assert Counter(map(tuple, got)) == Counter(map(tuple, staged(spark, docs)[last]))


def test_no_rows_and_clashing_columns(spark):
    assert all(not r for r in staged(spark, spark.createDataFrame([], SCHEMA)).values())
    docs = spark.createDataFrame(rows(), SCHEMA).selectExpr("*", "text AS spans", "doc_id AS id", "lang AS size")
    done = staged(spark, docs)
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert done[name] and set(done[name][0].asDict()) == set(docs.columns)


def test_masking_replaces_all_spans():
    model = personal_data.train()
    text = "call +1 (017) 555-7713 or a.b@c.example.com, from 10.0.0.1"
    ((_, spans),) = personal_data.find([text], model)
    assert personal_data.masked(text, spans) == "call <phone> or <email>, from <ip>"
    assert json.dumps(personal_data.masked("", [])) == '""'

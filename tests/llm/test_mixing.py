"""Targets against the rule written out, and what a mix must hold."""

import random
import time

from helpers import plan_of

from devicepulse.llm import mixing
from devicepulse.llm.mixing import Mix


def by_rule(sizes, weights=(1, 2, 3), most=3):
    """Share by weight, cap, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        got = {s: most * sizes[s] if s in capped else left * weight[s] / free for s in names}
        over = {s for s in names if s not in capped and got[s] > most * sizes[s]}
        if not over:
            return got
        capped |= over


def corpus(spark, sizes, seed=3, extra=()):
    rnd = random.Random(seed)
    rows, i = [], 0
    for source, total in sizes.items():
        while total > 0:
            n = min(total, rnd.randint(1, 90))
            rows.append((i, "  ".join(f"{source}w{i}x{k}" for k in range(n)), "en", source, 0))
            total -= n
            i += 1
    rows += extra
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


SIZES = {"a": 4000, "b": 90, "é": 900, "c": 5000, None: 3000, "d": 1, "": 700}
SMALL = Mix(block_words=8, shard_slots=64, bucket_docs=20)


def check(rows, sizes):
    want = by_rule(sizes)
    totals = {}
    for r in rows:
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        totals[r.source] = totals.get(r.source, 0) + r.taken
    for source, taken in totals.items():
        assert abs(taken - want[source]) <= 0.05 * want[source] + 3 * SMALL.block_words


def test_a_mix_is_near_its_targets(spark):
    rows = mixing.mix_sources(corpus(spark, SIZES), SMALL).collect()
    check(rows, SIZES)


def test_the_same_however_rows_are_spread(spark):
    docs = corpus(spark, SIZES)
    first = mixing.mix_sources(docs.repartition(1), SMALL).collect()
    second = mixing.mix_sources(docs.repartition(13), SMALL).collect()
    assert sorted(map(str, first)) == sorted(map(str, second))


def test_one_source_with_most_rows(spark):
    sizes = {"hot": 20000, "b": 500, "c": 400}
    check(mixing.mix_sources(corpus(spark, sizes), SMALL).collect(), sizes)


def test_repeated_rows_blank_texts_and_nulls(spark):
    same = (7, "one two three", "en", "a", 13)
    odd = [same, same, same, (None, None, None, "a", None), (None, None, None, "a", None), (9, " \t", "en", None, 2)]
    docs = corpus(spark, {"a": 400, "b": 800}, extra=odd)
    rows = mixing.mix_sources(docs, SMALL).collect()
    assert len(rows) == docs.count()
    assert sum(r.size == 0 and r.taken == 0 for r in rows) == 3
    assert sum(r.doc_id == 7 and r.size == 3 for r in rows) == 3
    check([r for r in rows if r.source], {"a": 409, "b": 800})


def test_only_blank_texts_and_no_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    blank = spark.createDataFrame([(1, None, None, None, None), (2, "", "x", "s", 0)], schema)
    assert {(r.doc_id, r.size, r.target, r.taken) for r in mixing.mix_sources(blank).collect()} == {
        (1, 0, 0.0, 0),
        (2, 0, 0.0, 0),
    }
    assert mixing.mixed_documents(blank).collect() == []
    assert mixing.mix_sources(blank.limit(0)).collect() == [] == mixing.mixed_documents(blank.limit(0)).collect()


def test_mixed_documents_hold_what_is_taken(spark):
    same = (100000, "one two three", "en", "a", 13)
    docs = corpus(spark, SIZES, extra=[same, same]).selectExpr("*", "n_chars AS uses", "lang AS mark")
    mixed = mixing.mixed_documents(docs, SMALL)
    assert mixed.schema.simpleString() == docs.schema.simpleString()
    got = mixed.collect()
    taken = mixing.mix_sources(docs, SMALL).collect()
    assert sum(len(r.text.split()) for r in got) == sum(r.taken for r in taken)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(len(r.text) == r.n_chars for r in got)
    whole = 0
    for r in got:
        known = set(texts[r.doc_id].split())
        assert all(w in known for w in r.text.split())
        whole += r.text == texts[r.doc_id]
    assert whole


def test_long_text(spark):
    rows = [(1, "w " * 50000, "en", "a", 0), (2, "v " * 300, "en", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: r for r in mixing.mix_sources(docs).collect()}
    assert got[1].size == 50000 and got[2].taken == 900
    assert abs(got[1].taken - got[1].target) < 400


def test_permutation_takes_every_block_once(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 64, 1001):
        j = spark.range(3 * n).select(F.col("id").alias("j"), F.lit(n).cast("bigint").alias("n_blocks"), F.lit(1).alias("source_no"))
        counts = j.select(mixing._permuted(Mix()).alias("b")).groupBy("b").count().collect()
        assert sorted((r.b, r["count"]) for r in counts) == [(b, 3) for b in range(n)]


def test_a_text_is_cut_into_words_once(spark):
    """Not once for each of its spans: a text of 200,000 words has thousands of them."""
    rows = [(1, " ".join(f"w{i}" for i in range(200_000)), "a"), (2, "b c", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    made = mixing.mixed_documents(docs)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    words = [line for line in plan.split("\n") if "regexp_extract_all" in line]
    assert words and not any("lambdafunction" in line and "regexp_extract_all" in line.split("lambdafunction", 1)[1] for line in words)
    began = time.monotonic()
    sizes = {r.doc_id: len(r.text.split()) for r in made.collect()}
    assert time.monotonic() - began < 60
    assert sizes


def test_short_tables_are_made_once(spark):
    """The driver plans the query anew after each of its stages, so no plan may hold the same steps many times."""
    docs = corpus(spark, SIZES)
    for made in (mixing.mixed_documents(docs, SMALL), mixing.mix_sources(docs, SMALL)):
        plan = plan_of(made)
        assert plan.count("Window [") <= 8 and plan.count("Exchange") <= 20, plan

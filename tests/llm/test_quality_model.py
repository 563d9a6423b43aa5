"""Held-out accuracy, the compiled rules against plain Python, and small tables."""

import math
import random

from devicepulse.llm import quality_model as q


def corpus(n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 8))) for _ in range(rnd.randint(30, 120))]
        good = rnd.random() < 0.7
        if not good:
            kind = rnd.randrange(3)
            if kind == 0:
                words = [w + rnd.choice(["***", "$$$"]) for w in words]
            elif kind == 1:
                words = words[:10] * 8
            else:
                words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), int(good)))
    return rows


def test_held_out_accuracy_and_reruns(spark):
    docs = spark.createDataFrame(corpus(600, 1), "doc_id bigint, text string, label int")
    labelled = q.with_statistics(docs)
    model = q.fit(labelled.repartition(3))
    assert model == q.fit(labelled.repartition(11))
    assert 0 < len(model.rules) < 60 and any(len(r.conditions) > 1 for r in model.rules)
    test = spark.createDataFrame(corpus(300, 2), "doc_id bigint, text string, label int")
    rows = q.score(test, model).collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum((r.score >= 0.3) == bool(r.label) for r in rows) >= 0.97 * len(rows)
    # The column gives what the rules say.
    by_id = {r.doc_id: r for r in q.with_statistics(test).collect()}
    for r in rows[:50]:
        total = model.bias + sum(
            w.weight
            for w in model.rules
            if all((by_id[r.doc_id][s] > t) == over for s, over, t in w.conditions)
        )
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-9


def test_blank_texts_clashing_columns_and_repeats(spark):
    model = q.RuleModel(0.5, (q.WeightedRule((("words", True, 1.0), ("symbols", False, 0.5)), 2.0),))
    rows = [(1, None, 1.0, "a"), (1, "", 1.0, "a"), (2, "one two three", 2.0, "b"), (2, "one two three", 2.0, "b")]
    rows += [(None, "w " * 100_000, 0.0, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, words double, score string")
    got = [(r.doc_id, round(r.score, 6)) for r in q.score(docs, model).collect()]
    low, high = 1 / (1 + math.exp(-0.5)), 1 / (1 + math.exp(-2.5))
    assert sorted(got, key=str) == sorted(
        [(1, round(low, 6)), (1, round(low, 6)), (2, round(high, 6)), (2, round(high, 6)), (None, round(high, 6))], key=str
    )


def test_no_labels_or_one_class(spark):
    schema = "doc_id bigint, text string, label int"
    none = q.fit(q.with_statistics(spark.createDataFrame([], schema)))
    assert none == q.RuleModel(0.0, ())
    one = q.fit(q.with_statistics(spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", None)], schema)))
    assert one.rules == () and abs(one.bias - math.log(3)) < 1e-9
    same = q.fit(q.with_statistics(spark.createDataFrame([(1, "a", 1), (2, "a", 0)], schema)))
    assert abs(same.bias) < 1e-6


def test_the_sample_is_bounded(spark):
    docs = q.with_statistics(spark.createDataFrame(corpus(200, 3), "doc_id bigint, text string, label int"))
    assert q.fit(docs, q.Fit(sample=50, trees=2)) == q.fit(docs.repartition(7), q.Fit(sample=50, trees=2))

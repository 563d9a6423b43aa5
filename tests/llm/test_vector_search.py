"""Answers against all products, whatever the lengths of the vectors and the sizes of buckets."""

import math
import random

import numpy as np
import pytest

from devicepulse.llm import vector_search as v

SCHEMA = "vec_id bigint, embedding array<double>"


def brute(rows, queries, k=10):
    def clean(x):
        ok = x is not None and all(c is not None and math.isfinite(c) for c in x)
        return [math.floor(1024 * c) for c in x] if ok else None

    usable = [(i, clean(x)) for i, x in rows if i is not None and clean(x) is not None]
    out = set()
    for q in {i for i, _ in queries}:
        mine = [c for i, c in usable if i == q]
        if not mine:
            continue
        own = max(mine)
        scored = sorted((-sum(a * b for a, b in zip(own, c)), i) for i, c in usable if i != q)
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


def answers(spark, rows, queries, parts=5, k=10):
    df, asked = spark.createDataFrame(rows, SCHEMA).repartition(parts), spark.createDataFrame(queries, SCHEMA)
    return {tuple(r) for r in v.top_k(df, asked, k).collect()}


@pytest.mark.parametrize("spread", [0.0, 0.3, 2.0])
def test_all_products(spark, monkeypatch, spread):
    rnd = random.Random(int(spread * 10))
    rows = []
    for i in range(700):
        length = math.exp(rnd.gauss(0, spread))
        rows.append((i, [rnd.gauss(0, 1) * length * (5 if j == i % 16 else 0.2) for j in range(16)]))
    monkeypatch.setattr(v, "BUCKET", 40)
    queries = [r for r in rows if r[0] % 20 == 0]
    assert answers(spark, rows, queries) == brute(rows, queries)


def test_every_way_of_pruning_is_taken(monkeypatch):
    rnd = np.random.default_rng(3)
    rows = rnd.integers(-9, 10, (600, 12)) * rnd.integers(1, 30, (600, 1))
    norms = np.sqrt((rows.astype(float) ** 2).sum(1))
    order = np.argsort(-norms, kind="stable")
    rows, norms, ids = rows[order], norms[order], np.arange(600)
    sizes, verify = [], v._verify
    monkeypatch.setattr(v, "_verify", lambda b, r, s, q, i: (sizes.append(len(i)), verify(b, r, s, q, i)))
    best = v._Best(5, 3, np.full(5, np.iinfo(np.int64).min))
    query_ids, queries = np.arange(1000, 1005), rows[100:105]
    for at in range(0, 600, 60):
        part = slice(at, at + 60)
        v._search_bucket(best, query_ids, queries, norms[100:105], ids[part], rows[part], norms[part])
    scores = queries @ rows.T
    assert (best.score == -np.sort(-scores, axis=1)[:, :3]).all()
    assert any(0 < n < 60 for n in sizes) and sum(sizes) < 5 * 600


def test_ties_repeated_rows_and_unusable_vectors(spark):
    one = [1.0, 0.0]
    rows = [(i, one) for i in range(30)] + [(3, one), (3, [0.5, 0.5]), (None, one), (100, None)]
    rows += [(101, [1.0, None]), (102, [float("nan"), 1.0]), (103, [float("inf"), 1.0]), (104, []), (105, [0.0, 0.0])]
    rows += [(106, [-1.0, -2.0]), (107, [2.0]), (108, [0.1, 0.2, 0.3])]
    df, asked = spark.createDataFrame(rows, SCHEMA), [r for r in rows if r[0] != 3]
    got = sorted(tuple(r) for r in v.top_k(df, spark.createDataFrame(asked, SCHEMA)).collect())

    def padded(x, n=3):
        return None if x is None else x + [0.0] * (n - len(x))

    want = brute([(i, padded(x)) for i, x in rows], [(i, padded(x)) for i, x in asked])
    assert set(got) == want
    assert len(got) == len(want) or any(r[2] == 3 for r in got)


def test_fewer_than_k_and_none(spark):
    rows = [(1, [1.0]), (2, [2.0]), (3, [-1.0])]
    assert answers(spark, rows, rows[:1]) == {(1, 1, 2, 2048 * 1024), (1, 2, 3, -(1024**2))}
    assert answers(spark, rows[:1], rows[:1]) == set()
    assert answers(spark, rows, []) == set() == answers(spark, [], rows)


def test_many_query_blocks(spark, monkeypatch):
    rnd = random.Random(8)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(120)]
    monkeypatch.setattr(v, "QUERY_BLOCK", 7)
    assert answers(spark, rows, rows[:40]) == brute(rows, rows[:40])


def test_large_components(spark):
    rows = [(1, [3e9, 1.0]), (2, [2.0, 5.0]), (3, [1e3, 1.0])]
    assert answers(spark, rows, rows[1:]) == brute(rows, rows[1:])
    with pytest.raises(Exception, match="64 bits"):
        answers(spark, [(1, [1e12]), (2, [1e12])], [(1, [1e12])])

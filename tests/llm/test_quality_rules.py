"""Measurements against plain Python, policies and ablations."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from devicepulse.llm import quality_rules as q


def measured(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = Counter(zip(w, w[1:], w[2:]))
    hit = {j for i in range(len(w) - 2) if wins[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in t),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
        "n_exclamations": t.count("!"),
    }


rnd = random.Random(5)
TEXTS = [None, "", " \n\t", "one", "a b", "a b c", "a b c a b c", "a a a a", "é 🎉 # |", "x\n\nx\n x\nx", "x " * 20000]
TEXTS += ["\x0b".join(rnd.choices("abcd", k=rnd.randint(0, 40))) for _ in range(60)]
TEXTS += [" ".join(rnd.choices([f"w{i}" for i in range(n)], k=300)) for n in (2, 5, 20, 100, 1000)]


def test_measurements(spark):
    docs = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(TEXTS)], "doc_id int, text string, n_words string")
    rows = q.measure(docs).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        want = measured(TEXTS[row.doc_id])
        assert {k: row[k] for k in want} == want


def test_policies_and_ablation(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    texts = [clean, clean, clean.upper(), clean + " ***" * 40, "short", "go on " * 40, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    ledger = q.ledger(docs)
    bits = {r.doc_id: r.failed_rules for r in ledger.collect()}
    assert bits[0] == bits[1] == 0 and bits[2] == 1 << 5 and bits[4] == 1 and bits[6] == 1
    assert bits[5] & 2 and bits[3] & 4
    kept = {r.doc_id for r in q.apply(docs).collect()}
    assert kept == {0, 1} and q.apply(docs, q.POLICIES[0]).count() == 4
    found = {(r.policy, r.version, r.rule): r for r in q.ablation(ledger).collect()}
    assert len(found) == sum(len(p.rules) for p in q.POLICIES)
    for policy in q.POLICIES:
        mask = policy.mask()
        for name in policy.rules:
            bit = 1 << [r.name for r in q.RULES].index(name)
            row = found[policy.name, policy.version, name]
            assert row.n_documents == 7
            assert row.n_kept == sum(b & mask == 0 for b in bits.values())
            assert row.n_failed == sum(b & bit > 0 for b in bits.values())
            assert row.n_only == sum(b & mask == bit for b in bits.values())


def test_apply_keeps_columns_that_clash(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, clean, "a", 2.5)], "doc_id int, text string, n_words string, failed_rules double")
    kept = q.apply(docs)
    assert kept.schema == docs.schema and kept.collect() == docs.collect()


def test_a_filter_evaluates_each_text_once(spark):
    docs = spark.createDataFrame([(1, "a b " * 5000)], "doc_id int, text string")
    plan = q.apply(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 2 and "Generate" in plan


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id int, text string")
    assert q.ledger(none).collect() == [] and q.apply(none).collect() == []
    assert q.ablation(q.ledger(none)).collect() == []


def test_no_shuffle_and_no_python(spark):
    plan = q.ledger(spark.createDataFrame([(1, "a")], "doc_id int, text string").coalesce(1))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text and text.count("split(") == 2


def test_too_many_rules(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id int, text string")
    with pytest.raises(ValueError, match="63"):
        q.ledger(docs, rules=[q.Rule(f"r{i}", "false") for i in range(64)])


def test_hashes_that_share_their_high_bits(spark):
    rnd = random.Random(12)
    rows = [(i, [16 * rnd.randrange(3) + rnd.randrange(4) for _ in range(rnd.randint(1, 15))]) for i in range(200)]
    rows += [(200, [17, 18, 17, 18, 17]), (201, [-1, -2, -1, -2, 5]), (202, [1 << 62, (1 << 62) + 1] * 3000)]
    found = spark.createDataFrame(rows, "id int, h array<bigint>").select("id", q._covered(F.col("h")).alias("n"))
    got = {r.id: r.n for r in found.collect()}
    for i, h in rows:
        counts = Counter(h)
        assert got[i] == len({j + k for j, x in enumerate(h) if counts[x] > 1 for k in range(3)}), h

"""Groups and sizes against all pairs."""

import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from devicepulse.llm import jaccard_join as j
from devicepulse.llm.jaccard_join import Join

SCHEMA = "doc_id bigint, text string"


def brute(rows, join):
    def lower(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)

    def shingles(t):
        w = lower(t or "").encode().split()
        n = join.width
        return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])

    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    at = defaultdict(list)
    for i, s in enumerate(sets):
        for k, o in Counter(k for t in s for k in at[t]).items():
            if 100 * o >= join.share * (len(s) + len(sets[k]) - o):
                parent[find(i)] = find(k)
        for t in s:
            at[t].append(i)
    least = {}
    for i, (id_, _) in enumerate(rows):
        if id_ is not None and sets[i]:
            least[find(i)] = min(id_, least.get(find(i), id_))
    return sorted(
        str((id_, len(sets[i]), least.get(find(i)) if sets[i] else id_)) for i, (id_, _) in enumerate(rows)
    )


def got(spark, rows, join, parts=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in j.link_documents(df, join).collect())


def test_numbers_of_links(spark):
    rows, join = corpus(6), Join(share=70, block_sets=4)
    shingler = j._Shingler(join)
    sets = {i: frozenset(shingler(t).tolist()) for i, t in rows if i is not None}
    different = set(sets.values()) | {frozenset(shingler(t).tolist()) for i, t in rows if i is None}
    df = spark.createDataFrame(rows, SCHEMA)
    for r in j.link_documents(df, join).where("doc_id IS NOT NULL").collect():
        mine = sets[r.doc_id]
        linked = [s for s in different if s != mine and s and 100 * len(s & mine) >= 70 * len(s | mine)]
        assert r.n_links == len(linked)


def edited(rnd, words, rate):
    return [w if rnd.random() > rate else f"e{rnd.randrange(10**6)}" for w in words]


def corpus(seed):
    """Copies, near copies on both sides of the threshold, chains, shared passages, blanks and short texts."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(3000)}"
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rnd.randint(20, 200))]
        for _ in range(rnd.randint(1, 5)):
            texts.append(" ".join(edited(rnd, base, rnd.choice([0, 0.01, 0.02, 0.05]))))
        texts.append(" ".join(passage + base[: rnd.randint(5, 60)]))
    chain = [word() for _ in range(150)]
    for _ in range(15):
        chain = chain[4:] + [word() for _ in range(4)]
        texts.append("\t".join(chain).upper())
    texts += ["one", "One", "one two", "a b c d", "a b c d e", "", " \n", None, None, "one\x0btwo"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[5]), (None, "alone here today and now so on"), (None, None), (-7, texts[8])]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,join", [(1, Join(width=4, share=85)), (2, Join()), (3, Join(share=60, block_sets=3))])
def test_all_pairs(spark, seed, join):
    rows = corpus(seed)
    assert got(spark, rows, join) == brute(rows, join)


def test_a_large_group_of_near_copies(spark):
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rnd, base, 0.02))) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]
    join = Join(width=4, share=85, block_sets=16)
    assert got(spark, rows, join, 7) == brute(rows, join)


def test_frequent_ngrams_change_only_the_order(spark):
    rows = corpus(4)
    assert got(spark, rows, Join(frequent=5)) == got(spark, rows, Join(frequent=0), 1) == brute(rows, Join())


def test_a_tree_finds_what_comparing_finds():
    rnd = random.Random(5)
    for share in (50, 80, 100):
        join = Join(share=share)
        for _ in range(60):
            pool = sorted(rnd.sample(range(10**6), 40))
            sets = [sorted(rnd.sample(pool, rnd.randint(1, 40))) for _ in range(12)]
            sets += [sets[0], sets[0][:5], sorted(set(sets[1]) | set(pool[:3]))]
            probe = rnd.choice(sets)
            raw = [np.array(s, ">u8").tobytes() for s in sets]
            rows = [(str(i).encode(), r) for i, r in enumerate(raw)]
            want = {
                str(i).encode()
                for i, s in enumerate(sets)
                if 100 * len(set(s) & set(probe)) >= share * len(set(s) | set(probe))
            }
            assert set(j.walk_tree(rows, np.array(probe, ">u8").tobytes(), join)) == want


def test_no_rows_long_text_and_extra_columns(spark):
    join = Join()
    assert got(spark, [], join) == [] and got(spark, [(1, None), (2, "")], join) == brute([(1, None), (2, "")], join)
    long = " ".join(f"x{i}" for i in range(60_000))
    docs = spark.createDataFrame([(1, long, "a", 1), (2, long + " y", "b", 2)], "doc_id bigint, text string, key string, n int")
    assert {(r.doc_id, r.component_id) for r in j.link_documents(docs).collect()} == {(1, 1), (2, 1)}


def test_repeated_rows_in_many_tasks_are_one_set(spark):
    rnd = random.Random(21)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(120)]
    texts = [" ".join(words[:i] + ["changed"] + words[i + 1 :]) for i in (2, 3, 118)]
    rows = [(i, t) for i, t in enumerate(texts) for _ in range(40)] + [(None, texts[0])] * 9
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    got = j.link_documents(docs, Join()).collect()
    assert len(got) == len(rows) and {r.component_id for r in got} == {0}
    assert {r.n_links for r in got} == {2}


def test_sets_of_a_family_move_once_for_each_part(spark):
    rnd = random.Random(22)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
    rows = [(i, " ".join(words[:i] + [f"x{i}"] + words[i + 1 :])) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    join = Join(block_sets=20)
    got = j.link_documents(docs, join).collect()
    assert {r.component_id for r in got} == {0} and {r.n_links for r in got} == {149}
    corpus = j._Corpus(docs, join, "doc_id", "text")
    keys = corpus.nodes.select("key", F.lit(b"f").alias("label"))
    sets = corpus.sets(keys, ("label", "tokens"))
    assert sets.count() == 150 and sets.columns == ["key", "tokens", "label"]
    found = corpus.compare_families(keys).where("b IS NULL").agg(F.sum("n")).first()[0]
    assert found == 150 * 149


def test_only_texts_of_candidates_are_moved(spark):
    rnd = random.Random(23)
    rows = [(i, " ".join(f"w{rnd.randrange(10**6)}" for _ in range(30))) for i in range(400)]
    rows += [(None, rows[0][1]), (400, rows[1][1] + " more"), (401, None), (None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    corpus = j._Corpus(docs, Join(), "doc_id", "text")
    chosen = corpus.docs.where("id IS NULL OR id IN (1, 400, 401)").select(F.col("id").alias("_id"), F.col("mark").alias("_mark"))
    found = [(r.id, r.text) for r in corpus.texts_of(chosen).collect()]
    assert {rows[1], *rows[400:]} <= set(found) and len(found) < 40
    none = corpus.texts_of(chosen.where("false"))
    assert none.count() == 0
    # A set's centre is stored with its n-grams, so none of them moves again to find it.
    shared = corpus.prefixes()
    assert shared.columns == ["token", "key", "centre"]
    assert shared.groupBy("token").agg(F.count_distinct("centre").alias("n")).where("n <> 1").isEmpty()


def test_ngrams_of_the_same_sets_move_as_one(spark):
    rnd = random.Random(24)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(300)]
    rows = [(0, " ".join(words)), (1, " ".join(words[:-1])), (2, " ".join(words[1:-1])), (3, "alone here today and now")]
    corpus = j._Corpus(spark.createDataFrame(rows, SCHEMA).repartition(3), Join(), "doc_id", "text")
    each, folded = corpus.prefixes(), corpus.meetings()
    assert folded.agg(F.sum("m")).first()[0] == each.count() > 100
    # No more rows than there are choices of two or more of the three sets, with their members.
    assert folded.count() <= 9 and folded.columns == ["token", "key", "centre", "m"]
    assert folded.agg(F.max(F.length("key"))).first()[0] == 12


def test_repeated_rows_leave_a_task_once(spark):
    docs = spark.range(60).selectExpr("id % 2 AS id", "cast(7 AS bigint) AS mark", "'a b' AS text").repartition(3)
    nulls = docs.selectExpr("cast(null AS bigint) AS id", "mark", "text")
    assert j._once(docs.unionByName(nulls).coalesce(2)).count() <= 6


def near_sets(rnd, n, size, edits):
    base, made = rnd.sample(range(1 << 62), size), []
    for _ in range(n):
        changed = set(base)
        for _ in range(rnd.randint(0, edits)):
            changed.discard(rnd.choice(base))
            changed.add(rnd.choice([rnd.randrange(1 << 62), rnd.choice(base) | 1 << 62]))
        made.append(np.array(sorted(changed), np.uint64))
    return list({m.tobytes(): m for m in made}.values())


@pytest.mark.parametrize("probe_bytes", [16, j.PROBE_BYTES])
def test_probes_that_walk_together_find_what_comparing_finds(monkeypatch, probe_bytes):
    monkeypatch.setattr(j, "PROBE_BYTES", probe_bytes)
    rnd = random.Random(31)
    for share in (30, 85, 100):
        join = Join(share=share)
        links = lambda x, y: 100 * len(x & y) >= share * len(x | y)  # noqa: E731, B023
        for size in (1, 9, 90):
            rows, probes = near_sets(rnd, 20, size, 12), near_sets(rnd, 9, size, 12)
            probes += [rows[0], rows[-1][: size // 2 + 1], np.empty(0, np.uint64)]
            a, b = ([set(s.tolist()) for s in side] for side in (rows, probes))
            got = sorted((i, int(k)) for i, found in j.walk_tree_together(rows, probes, join) for k in found)
            assert got == [(i, k) for i, x in enumerate(a) for k, y in enumerate(b) if links(x, y)]
            got = sorted((i, int(k)) for i, found in j.walk_tree_together(rows, rows, join, same=True) for k in found)
            assert got == [(i, k) for i in range(len(a)) for k in range(i + 1, len(a)) if links(a[i], a[k])]


def test_a_part_of_near_copies_takes_no_time_for_each_pair():
    # One probe after the other took some 100 us a pair, 100 s for these.
    sets = near_sets(random.Random(32), 1500, 400, 10)
    began = time.process_time()
    found = sum(len(f) for _, f in j.walk_tree_together(sets, sets, Join(share=85), same=True))
    assert found == len(sets) * (len(sets) - 1) // 2 and time.process_time() - began < 25


def test_parts_without_sets_count_no_link_twice(spark, monkeypatch):
    rnd = random.Random(33)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
    rows = [(i, " ".join(words[:i] + [f"x{i}"] + words[i + 1 :])) for i in range(12)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    monkeypatch.setattr(j, "PART_GRAMS", 150)
    for join in (Join(block_sets=1), Join()):
        got = j.link_documents(docs, join).collect()
        assert {(r.component_id, r.n_links) for r in got} == {(0, 11)}


def test_sets_of_many_texts_at_once():
    rnd = random.Random(34)
    word = lambda: rnd.choice(["a", "B", "é", "Ab", "x" * 70, "y" * 64, "nbsp\xa0in", "u\u2003v", "c\x1cd", "0" * rnd.randint(1, 90)])
    space = lambda: rnd.choice([" ", "\t", "\n ", "\r\n", "\x0b", "\x0c  "])
    texts = ["".join(word() + space() for _ in range(rnd.randint(0, 40))) for _ in range(200)]
    texts += [None, "", " \n", "one", "One two", "z" * 200_000, "z" * 200_000 + " z", " ".join(f"w{i % 9000}" for i in range(40_000))]
    texts += ["ab ba", "ba ab", "abba baab baababba abbabaab", "a\x00b", "a\x00b\x00"]
    join = Join(width=3)
    low = [bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()) for t in texts]
    words = [b.split() for b in low]
    want = [{tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} - {()} for w in words]
    plain = j._Shingler(join)
    made = plain.keyed(texts)
    assert [len(s) for _, s in made] == [len(w) for w in want]
    assert len({k for k, _ in made}) == len({frozenset(w) for w in want})
    # Equal n-grams are equal in whatever text and place.
    everything = np.concatenate([s for _, s in made])
    assert len(np.unique(everything)) == len(set().union(*want))
    often = np.unique(everything)[::3]
    for text, (key, tokens), (other, ordered) in zip(texts, made, j._Shingler(join, often).keyed(texts), strict=True):
        heavy = np.isin(tokens, often)
        assert key == other and ordered.tolist() == [*tokens[~heavy].tolist(), *(t | 1 << 62 for t in tokens[heavy].tolist())]
        assert plain(text).tolist() == tokens.tolist()

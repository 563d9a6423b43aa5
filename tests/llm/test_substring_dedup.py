"""Planted passages, cuts against their definition, and what is left of the texts."""

import random
from collections import Counter

import numpy as np

from devicepulse.llm import substring_dedup as d
from devicepulse.llm.substring_dedup import Chunking

SCHEMA = "doc_id bigint, text string, begin string"


def prose(rnd, n):
    return " ".join("".join(rnd.choices("abcdeéfghijkl", k=rnd.randint(2, 9))) for _ in range(n))


def test_the_hash_and_the_cuts_are_as_defined():
    rnd, c = random.Random(1), Chunking(reach=6, longest=40)
    gears = d._gears(c.seed).astype(object)
    for text in [prose(rnd, 60), "a" * 200, "ab", "é" * 50, "x"]:
        data = np.frombuffer(text.encode(), np.uint8)
        h = [sum(int(gears[data[i - k]]) << k for k in range(32) if k <= i) % 2**32 for i in range(len(data))]
        assert d.rolling(data, d._gears(c.seed)).tolist() == h
        ends = {
            i + 1
            for i in range(len(h))
            if all(h[i] < x for x in h[max(0, i - 6) : i]) and all(h[i] <= x for x in h[i + 1 : i + 7])
        } | {len(h)}
        found = d.cuts(data, c).tolist()
        assert found[-1] == len(data) and all(b - a <= 44 for a, b in zip([0, *found], found))
        starts = {len(text[:k].encode()) for k in range(len(text) + 1)}
        assert set(found) <= starts
        assert {min(s for s in starts if s >= e) for e in ends} <= set(found)
        words, before, after = d.words_of_chunks(data, np.array(found), c)
        assert words.sum() == len(text.split())
        # Around a chunk, no more than there is before and after it.
        assert before[0] == 0 == after[-1] and (before <= np.cumsum(words) - words).all()
        assert (after <= words.sum() - np.cumsum(words)).all()


def test_an_insertion_moves_only_cuts_nearby():
    rnd = random.Random(2)
    text = prose(rnd, 2000)
    changed = text[:3000] + "inserted" + text[3000:]
    parts = []
    for t in (text, changed):
        raw = t.encode()
        ends = d.cuts(np.frombuffer(raw, np.uint8), Chunking()).tolist()
        parts.append({raw[a:b] for a, b in zip([0, *ends], ends)})
    assert len(parts[0] - parts[1]) <= 4


def test_planted_passages_are_found_and_clean_texts_left(spark):
    rnd = random.Random(3)
    rows, planted = [], set()
    for p in range(12):
        passage = prose(rnd, 51)
        for _ in range(rnd.randint(2, 4)):
            i = len(rows)
            planted.add(i)
            rows.append((i, f"{prose(rnd, 100)} {passage} {prose(rnd, 100)}", None))
    for _ in range(60):
        rows.append((len(rows), prose(rnd, 200), None))
    docs = spark.createDataFrame(rows, SCHEMA)
    got = d.repeated_passages(docs).collect()
    assert {r.doc_id for r in got} == planted
    assert sum(r.is_first for r in got) == 12
    for r in got:
        part = rows[r.doc_id][1].encode()[r.begin : r.end].decode()
        assert part in rows[r.first_doc][1] and r.n_words >= 25
    texts = {r.doc_id: r.text for r in d.without_repeats(docs).collect()}
    for r in got:
        whole = rows[r.doc_id][1]
        part = whole.encode()[r.begin : r.end].decode()
        assert texts[r.doc_id] == (whole if r.is_first else whole.replace(part, ""))
    assert all(texts[i] == rows[i][1] for i in range(len(rows)) if i not in planted)


def test_copies_repeats_nulls_and_long_texts(spark):
    rnd = random.Random(4)
    text, other, long = prose(rnd, 80), prose(rnd, 80), prose(rnd, 40_000)
    rows = [(1, text, "a"), (1, text, "a"), (2, text, "b"), (3, other, None), (3, other, None), (4, None, None)]
    rows += [(5, "", None), (None, other, "n"), (None, prose(rnd, 80), None), (6, long, None), (7, "x " + long, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {(r.doc_id, r.is_first) for r in d.repeated_passages(docs).collect()}
    assert found >= {(1, True), (2, False), (6, True), (7, False)} and {i for i, _ in found} == {1, 2, 3, 6, 7, None}
    left = d.without_repeats(docs)
    assert left.schema == docs.schema and left.count() == len(rows)
    texts = {(r.doc_id, r.begin): r.text for r in left.collect()}
    assert texts[1, "a"] == text and texts[2, "b"] == "" and texts[4, None] is None and texts[5, None] == ""
    assert len(texts[7, None]) < 200


def test_near_copies_keep_every_passage_once(spark):
    rnd = random.Random(5)
    head, old, new, tail = (prose(rnd, n) for n in (150, 40, 40, 150))
    family = {1: f"{head} {old} {tail}", 2: f"{head} {new} {tail}", 3: f"{head} {new} {tail}"}
    docs = spark.createDataFrame([(i, t, None) for i, t in family.items()], SCHEMA)
    at = len(head.encode()) + 1, len(f"{head} {new}".encode())
    middle = sum(at) // 2
    rows = d.repeated_passages(docs).collect()
    # The sentence is first in 2, on its own; what is around it is not, in two parts.
    first = [r for r in rows if r.doc_id == 2 and r.is_first]
    assert len(first) == 1 and first[0].begin <= middle < first[0].end and first[0].first_doc == 2
    others = [r for r in rows if r.doc_id == 2 and not r.is_first]
    assert len(others) == 2 and not any(r.begin <= middle < r.end for r in others)
    left = [r.text for r in d.without_repeats(docs).collect()]
    held = Counter()
    for text in family.values():
        raw = text.encode()
        ends = d.cuts(np.frombuffer(raw, np.uint8), d.FINE).tolist()
        held.update({raw[a:b].decode() for a, b in zip([0, *ends], ends) if b < len(raw)})
    # A text's last chunk may be a few letters, which stand elsewhere too; a chunk next to the edit may be part
    # of a longer one of another text.
    for chunk, n in held.items():
        kept = sum(chunk in text for text in left)
        assert kept == 1 if n == 3 else kept >= 1
    assert sum(new[60:180] in text for text in left) == 1 == sum(old[60:180] in text for text in left)


def common_words(one, other, chunking):
    """The most words in a row of `other` whose chunks are chunks of `one`, with those around the run."""
    pieces = []
    for t in (one, other):
        data = np.frombuffer(t.encode(), np.uint8)
        ends = d.cuts(data, chunking)
        words = d.words_of_chunks(data, ends, chunking).T.tolist()
        pieces.append([(t.encode()[a:b], n) for a, b, n in zip([0, *ends.tolist()], ends.tolist(), words)])
    held, best, run, lead = {c for c, _ in pieces[0]}, 0, 0, 0
    for c, (n, before, after) in pieces[1]:
        run, lead = (run + n, lead if run else before) if c in held else (0, 0)
        best = max(best, lead + run + after if run else 0)
    return best


def short_words(rnd, n, letters="etaoinshrdlu", longest=3):
    return " ".join("".join(rnd.choices(letters, k=rnd.randint(1, longest))) for _ in range(n))


def test_passages_of_short_words_are_found():
    rnd, c = random.Random(6), d.FINE
    for letters, least in (("etaoinshrdlu", 298), ("0123456789", 298)):
        found = 0
        for _ in range(300):
            passage = short_words(rnd, 51, letters)
            one, other = (f"{short_words(rnd, 40, letters)} {passage} {short_words(rnd, 40, letters)}" for _ in range(2))
            found += common_words(one, other, c) >= c.words
        assert found >= least


def test_what_repeats_within_a_reach_is_cut_alike_anywhere():
    rnd = random.Random(8)
    for period in ("a ", "ab cd ", "0 1 2 3 4 5 ", "é ü "):
        passage = period * 60
        for _ in range(20):
            one, other = (f"{prose(rnd, rnd.randint(5, 40))} {passage} {prose(rnd, 20)}" for _ in range(2))
            assert common_words(one, other, d.FINE) >= 8


def test_long_repeats_without_spaces_are_found(spark):
    rnd = random.Random(9)
    token = lambda letters, n: "".join(rnd.choices(letters, k=n))
    han, code = "".join(map(chr, range(0x4E00, 0x4F00))), "abcdefgh0123(){};,.=+"
    rows = []
    for letters, n in ((han, 150), (code, 450)):
        passage = token(letters, n)
        rows += [(len(rows) + k, token(letters, n) + passage + token(letters, n), None) for k in range(2)]
        rows += [(len(rows), token(letters, n), None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {(r.doc_id, r.is_first) for r in d.repeated_passages(docs).collect()} == {(0, True), (1, False), (3, True), (4, False)}
    texts = {r.doc_id: r.text for r in d.without_repeats(docs).collect()}
    assert all((len(texts[i]) < len(t) * 0.8) == (i in (1, 4)) for i, t, _ in rows)


def test_short_passages_are_left_and_those_asked_for_are_never_lost(spark):
    rnd, rows = random.Random(10), []
    lengths = (8, 15, 20, 50, 51, 60) * 10
    for n in lengths:
        passage = prose(rnd, n)
        rows += [(len(rows) + k, f"{prose(rnd, 80)} {passage} {prose(rnd, 80)}", None) for k in range(2)]
    got = {r.doc_id for r in d.repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i for i, _, _ in rows if lengths[i // 2] >= 50}


def brute_passages(texts, c):
    """Maximal runs of chunks that another text holds, with enough words around: {(text, begin, end)}."""
    cut = {}
    for i, t in texts.items():
        data = np.frombuffer(t.encode(), np.uint8)
        ends = d.cuts(data, c)
        spans = list(zip([0, *ends.tolist()], ends.tolist()))
        cut[i] = [(t.encode()[a:b], a, b, *w) for (a, b), w in zip(spans, d.words_of_chunks(data, ends, c).T.tolist())]
    holders = {}
    for i, parts in cut.items():
        for part in parts:
            holders.setdefault(part[0], set()).add(i)
    found = set()
    for i, parts in cut.items():
        run = []
        for part in [*parts, None]:
            if part and len(holders[part[0]]) > 1:
                run.append(part)
                continue
            if run:
                kinds = [min(holders[p[0]]) == i for p in run]
                groups, at = [], 0
                for k in range(1, len(run) + 1):
                    if k == len(run) or kinds[k] != kinds[at]:
                        groups.append((kinds[at], run[at:k]))
                        at = k
                for first, group in groups:
                    whole = group if first else [p for f, g in groups if not f for p in g]
                    words, size = sum(p[3] for p in whole), sum(p[2] - p[1] for p in whole)
                    around = whole[0][4] + whole[-1][5]
                    if words + around >= c.words or (size >= c.size and size > c.word_bytes * words):
                        found.add((i, group[0][1], group[-1][2], first))
            run = []
    return found


def test_passages_against_a_plain_program(spark):
    rnd, texts = random.Random(11), {}
    shared = [prose(rnd, rnd.choice((10, 25, 60, 120))) for _ in range(8)]
    for i in range(40):
        parts = [rnd.choice(shared) if rnd.random() < 0.4 else prose(rnd, rnd.randint(1, 60)) for _ in range(6)]
        texts[i] = " ".join(parts)
    docs = spark.createDataFrame([(i, t, None) for i, t in texts.items()], SCHEMA)
    # A filter of one word lets nearly all through, a larger one hardly any; the passages are the same.
    for bits in (64, 1 << 16):
        c = d.Chunking(reach=16, window=8, filter_bits=bits)
        got = {(r.doc_id, r.begin, r.end, r.is_first) for r in d.repeated_passages(docs, c).collect()}
        assert got == brute_passages(texts, c) and len(got) > 20


def test_the_filter_holds_back_chunks_of_one_place(spark):
    rows = [(i, str(i).encode()) for i in range(5000)] + [(i, str(i).encode()) for i in range(100)]
    kept = d._repeated_only(spark.createDataFrame(rows, "doc bigint, digest binary").repartition(3), 1 << 16)
    counts = Counter(r.doc for r in kept.collect())
    assert all(counts[i] == 2 for i in range(100)) and len(counts) < 110


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert d.repeated_passages(none).collect() == [] == d.without_repeats(none).collect()

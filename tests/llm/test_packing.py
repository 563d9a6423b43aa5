"""Pieces against the tokenizers library, sequences against what a packing must be, sums against loops."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest

from devicepulse.llm import packing as p
from devicepulse.llm.coders import ByteLevel, Coder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def coder(spark):
    return Coder(spark, PATH, ByteLevel)


def library_pieces(texts, capacity=1024):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    out = []
    for i, text in enumerate(texts):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % capacity or capacity
        bounds = [0, *range(first, len(ids) + 1, capacity)]
        for n, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
            crc = zlib.crc32(np.array(ids[lo:hi], "<u4").tobytes())
            out.append((i, n, lo, hi - lo, crc))
    return out


def check_packing(rows, capacity):
    """Gapless sequences of at most `capacity` tokens; returns how many there are."""
    held = defaultdict(list)
    for sequence, offset, length in rows:
        held[sequence].append((offset, length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_pieces_equal_the_library(spark, coder):
    rnd = random.Random(2)
    words = ["the", " ", "größer", "漢字", "😀", "<|endoftext|>", "\n\n", "don't", "12345", " ", "a" * 700]
    texts = [None, "", " ", "a" * 9000, "<|endoftext|>" * 1200, " " * 5000]
    texts += ["".join(rnd.choices(words, k=rnd.randint(1, 3000))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    for capacity in (1024, 7):
        made = p.cut(df, coder, capacity=capacity).collect()
        got = [(r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.tokens)) for r in made]
        assert sorted(got) == library_pieces(texts, capacity)


def test_sums_are_counted_while_lengths_run_out():
    rnd = random.Random(4)
    counts = np.zeros(40, int)
    for x in rnd.sample(range(1, 40), 15):
        counts[x] = rnd.randint(1, 3)
    sums = p.Sums(counts)
    while True:
        left = [x for x in range(40) if sums.left[x]]
        for k, got in ((2, sums.two), (3, sums.three)):
            want = Counter(sum(c) for c in product(left, repeat=k))
            assert got.tolist() == [want[s] for s in range(40)]
        if not left:
            break
        sums.take(Counter([rnd.choice(left)]), 1)


def test_an_exact_fill_is_found_whenever_there_is_one():
    rnd = random.Random(6)
    for _ in range(300):
        counts = np.zeros(31, int)
        for _ in range(rnd.randint(1, 6)):
            counts[rnd.randint(1, 30)] += 1
        left = [x for x in range(31) for _ in range(counts[x])]
        ways = {1: set(), 2: set(), 3: set()}
        for k in ways:
            for c in product(range(len(left)), repeat=k):
                if len(set(c)) == k:
                    ways[k].add(sum(left[i] for i in c))
        for gap in range(1, 31):
            found = p.Sums(counts).exactly(gap, Counter())
            possible = any(gap in ways[k] for k in ways)
            assert (found is not None) == possible
            if found:
                assert sum(found) == gap and not Counter(found) - Counter(left)


@pytest.mark.parametrize("kind", ["even", "short", "middle", "equal", "large"])
def test_combinations_use_all_and_come_near_the_bound(kind):
    rnd = np.random.default_rng(8)
    lengths = {
        "even": rnd.integers(1, 1025, 20000),
        "short": np.clip(rnd.lognormal(4, 1, 20000), 1, 1024).astype(int),
        "middle": rnd.integers(300, 700, 20000),
        "equal": np.full(1000, 300),
        "large": rnd.integers(513, 1025, 500),
    }[kind]
    found = p.combinations(np.bincount(lengths, minlength=1025), 1024)
    used = Counter()
    for held, times in found:
        assert sum(held) <= 1024 and times > 0
        for x in held:
            used[x] += times
    assert used == Counter(lengths.tolist())
    made = sum(times for _, times in found)
    least = max(-(-int(lengths.sum()) // 1024), int((lengths > 512).sum()))
    least = {"equal": -(-1000 // 3)}.get(kind, least)
    assert made <= least * 1.01 + 1


def test_small_cases_take_as_few_as_all_ways_of_packing():
    """Against the best of all assignments of up to seven pieces."""

    def best(parts, room):
        def fits(n):
            loads = [0] * n

            def put(i):
                if i == len(parts):
                    return True
                for j in range(n):
                    if loads[j] + parts[i] <= room and (j == 0 or loads[j] != loads[j - 1]):
                        loads[j] += parts[i]
                        if put(i + 1):
                            return True
                        loads[j] -= parts[i]
                return False

            return put(0)

        return next(n for n in range(1, len(parts) + 1) if fits(n))

    rnd, more = random.Random(3), 0
    for _ in range(300):
        parts = [rnd.randint(1, 12) for _ in range(rnd.randint(1, 7))]
        made = sum(t for _, t in p.combinations(np.bincount(parts, minlength=13), 12))
        least = best(sorted(parts, reverse=True), 12)
        assert made <= least + 1
        more += made > least
    assert more <= 6


def test_pack_on_any_partitioning(spark):
    rnd = random.Random(9)
    # A third of all pieces have one length.
    lengths = [512] * 1000 + [rnd.randint(1, 1024) for _ in range(2000)]
    rows = [(i, n, "old") for i, n in enumerate(lengths)]
    least = sum(t for _, t in p.combinations(np.bincount(lengths, minlength=1025), 1024))
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "doc_id bigint, length bigint, sequence_id string").repartition(parts)
        made = p.pack(df).collect()
        assert sorted((r.doc_id, r.length) for r in made) == [(i, n) for i, n, _ in rows]
        assert check_packing([(r.sequence_id, r.offset, r.length) for r in made], 1024) == least


def test_empty_table_extra_columns_and_repeated_rows(spark, coder):
    schema = "doc_id bigint, text string, piece string, size string, at string, part string, given string"
    empty = spark.createDataFrame([], schema)
    assert p.pack(p.cut(empty, coder).drop("tokens")).count() == 0
    rows = [(1, "a b", "x", "s", "t", "u", "v"), (1, "a b", "x", "s", "t", "u", "v"), (None, None, None, None, None, None, None)]
    made = p.pack(p.cut(spark.createDataFrame(rows, schema), coder)).collect()
    assert sorted((r.doc_id or 0, r.piece, r.length, r["size"], r.given) for r in made) == [
        (0, 0, 1, None, None),
        (1, 0, 3, "s", "v"),
        (1, 0, 3, "s", "v"),
    ]
    assert check_packing([(r.sequence_id, r.offset, r.length) for r in made], 1024) == 1


def test_bad_lengths_fail(spark):
    for bad in (0, 1025, None):
        with pytest.raises(Exception, match="1 to 1024"):
            p.pack(spark.createDataFrame([(bad,)], "length bigint")).count()


def test_registered_query(spark):
    import pyarrow.parquet as pq

    from devicepulse.llm.catalog import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    ids = [d["doc_id"] for d in docs]
    want = sorted((ids[i], *rest) for i, *rest in library_pieces([d["text"] for d in docs]))
    got = QUERIES["op12_packing"](spark, folder)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got.collect()
    assert sorted(tuple(r)[:5] for r in rows) == want
    n = check_packing([(r.sequence_id, r.offset, r.length) for r in rows], 1024)
    assert n <= -(-sum(r.length for r in rows) // 1024) + 2

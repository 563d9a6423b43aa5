"""Alignment of two tokenizers against plain loops over the libraries' tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark import cloudpickle

from devicepulse.llm import alignment as al
from devicepulse.llm.coders import ByteLevel, Coder, Pieces

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def coders(spark):
    return Coder(spark, A, ByteLevel), Coder(spark, B, Pieces)


class Brute:
    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(A)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        signs = {chr(x): x for x in shown}
        signs |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
        self.signs = signs

    def groups(self, text):
        if not text:
            return []
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        a = [(i, bytes(self.signs[c] for c in self.a.id_to_token(i))) for i in ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        want = (" " + text).encode()
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            return []
        ends = []
        for side in (a, b):
            at, here = 0, []
            for _, x in side:
                at += len(x)
                here.append(at)
            ends.append(here)
        common = sorted(set(ends[0]) & set(ends[1]))
        out, before = [], 0
        for e in common:
            out.append(
                tuple(
                    [i for (i, _), end in zip(side, here, strict=True) if before < end <= e]
                    for side, here in zip((a, b), ends, strict=True)
                )
            )
            before = e
        return out

    def rows(self, texts):
        cut = [self.groups(t) for t in texts]
        links = [Counter((x, y) for a, b in g for x in a for y in b) for g in cut]
        docs = Counter(p for held in links for p in held)
        highest = defaultdict(int)
        for (x, _), n in docs.items():
            highest[x] = max(highest[x], n)
        out = []
        for g, held in zip(cut, links, strict=True):
            shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            out.append(
                (
                    sum(len(a) for a, _ in g),
                    sum(len(b) for _, b in g),
                    len(g),
                    sum(held.values()),
                    sum(n for p, n in held.items() if docs[p] == highest[p[0]]),
                    sum(n * docs[p] for p, n in held.items()),
                    shown,
                )
            )
        totals = Counter()
        for held in links:
            totals.update(held)
        return out, {(x, y, docs[x, y], totals[x, y]) for x, y in docs}


def texts():
    rnd = random.Random(5)
    words = "the of Ärger größer naïve 1234 3.14 foo_bar 漢字 かな 😀 don't  x == ==== <|endoftext|> <s> </s> ▁ \n \t".split(" ")
    out = [None, "", " ", "a", "▁", "a b", "a b", " x", "x▁y", "\x00", "<|endoftext|>", "aaaa" * 300, "=-" * 700]
    out += ["漢" * 90, "né " * 200, "  leading", "trailing  ", "\r\n\r\n", "é"]
    out += [" ".join(rnd.choices(words, k=rnd.randint(1, 60))) for _ in range(150)]
    return out


def rows_of(spark, coders, given, parts):
    df = spark.createDataFrame(list(enumerate(given)), "doc_id bigint, text string").repartition(parts)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    made = al.align(df, *coders).collect()
    return [tuple(r[n] for n in names) for r in sorted(made, key=lambda r: r.doc.doc_id)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_loops(spark, coders, monkeypatch, small):
    given = texts()
    want, _ = Brute().rows(given)
    if small:
        # Blocks of a few documents. Workers see changed constants only where the module is pickled by value.
        monkeypatch.setattr(al, "BLOCK_ENTRIES", 200)
        monkeypatch.setattr(al, "BATCH_BYTES", 500)
        cloudpickle.register_pickle_by_value(al)
    try:
        assert rows_of(spark, coders, given, 3) == want
    finally:
        if small:
            cloudpickle.unregister_pickle_by_value(al)


def test_counts_of_pairs(spark, coders):
    given = texts()
    _, want = Brute().rows(given)
    df = spark.createDataFrame([(t,) for t in given], "text string").repartition(4)
    index = al.stored(al.index(df, *coders), "alignment")
    assert {tuple(r) for r in al.pair_counts(index).collect()} == want


def test_empty_table_and_columns_of_the_same_name(spark, coders):
    schema = "doc_id bigint, text string, block string, posting string, n_a string, doc string"
    assert al.align(spark.createDataFrame([], schema), *coders).count() == 0
    rows = [(1, "a cat", "x", "y", "z", None), (None, None, None, None, None, None), (1, "a cat", "x", "y", "z", None)]
    made = al.align(spark.createDataFrame(rows, schema), *coders).collect()
    assert sorted((r.doc.doc_id or 0, r.doc.n_a, r.n_a, r.count_sum) for r in made) == [
        (0, None, 0, 0),
        (1, "z", 2, 4),
        (1, "z", 2, 4),
    ]


def test_planes_there_and_back():
    rnd = np.random.default_rng(1)
    for documents, share in ((10, 0.5), (5000, 0.002), (65536, 0.3)):
        rows = 7
        marks = rnd.random((rows, documents)) < share * rnd.random((rows, 1))
        row, number = np.nonzero(marks)
        times = rnd.integers(1, 9, len(row))
        planes = al.write_planes(row, number, times, rows, documents)
        back_row, plane, back_number = al.read_planes(planes)
        total = np.zeros((rows, documents), int)
        np.add.at(total, (back_row, back_number), 1 << plane)
        want = np.zeros((rows, documents), int)
        want[row, number] = times
        assert (total == want).all()
        assert (al.merged_documents(back_row, back_number, rows) == marks.sum(1)).all()
        part = planes.slice(2, 3)
        got = al.read_planes(part)
        assert [len(got[0][got[0] == r]) for r in range(3)] == [int((back_row == r + 2).sum()) for r in range(3)]


def test_large_groups_are_counted_by_equal_ids(coders):
    """A run that the vocabularies cut at unlike places makes a group of many tokens."""
    text = "x" + "=-" * 3001 + "漢" * 50 + " " * 3001 + "aé" * 999
    made = al._Batch(coders[0].load(), coders[1].load(), [text])
    want = Counter((x, y) for a, b in Brute().groups(text) for x in a for y in b)
    got = Counter()
    for pair, _, times in made.entries():
        for p, n in zip(pair.tolist(), times.tolist(), strict=True):
            got[divmod(p, len(coders[1].load().bytes))] += n
    assert got == want


def test_registered_query(spark):
    import pyarrow.parquet as pq

    from devicepulse.llm.catalog import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want, _ = Brute().rows([d["text"] for d in docs])
    digest = {
        d["doc_id"]: (*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest() if w[0] else "")
        for d, w in zip(docs, want, strict=True)
    }
    got = QUERIES["op11_alignment"](spark, folder)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got.columns == ["doc_id", *names]
    assert {r.doc_id: tuple(r[n] for n in names) for r in got.collect()} == digest

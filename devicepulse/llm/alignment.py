"""Alignment of two tokenizers over a corpus, by inverted bitmaps of token pairs.

A text is encoded by both; the byte offsets where tokens of both end cut it into groups, and every token of
the one is linked with every token of the other in its group. Documents are numbered within blocks of a
bounded size. A block's postings hold, for each pair of ids linked in it, a bitmap of its documents in planes:
plane k has the documents in which bit k of the pair's multiplicity is set. A plane is a sorted list
of 16-bit numbers or, where that is shorter, plain bits.

The planes of a pair OR-merged and counted are its documents, the planes counted and weighed its links.
Blocks share no document, so counts of blocks add up. For scores each posting takes its pair's count back to
the documents that its planes name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicepulse.llm.coders import Coder
from devicepulse.llm.common import sized, stored

BATCH_BYTES = 2 << 20
BLOCK_ROWS = 1 << 16  # documents of a block: their numbers have 16 bits
BLOCK_ENTRIES = 1 << 22  # pairs of documents of a block, more or less
ROWS = 1 << 13  # postings in one Arrow batch
LISTED, PLAIN = 0, 1  # the first byte of a plane

POSTING = T.StructType(
    [
        T.StructField("a", T.IntegerType()),
        T.StructField("b", T.IntegerType()),
        T.StructField("planes", T.ArrayType(T.BinaryType())),
    ]
)
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


# Planes ------------------------------------------------------------------------------------------------


def write_planes(row: np.ndarray, number: np.ndarray, times: np.ndarray, rows: int, documents: int) -> pa.Array:
    """A list of planes for each of `rows`, from (row, document number, multiplicity) in order of row and
    number; numbers are below `documents`."""
    bits = np.zeros(rows, np.int64)
    np.maximum.at(bits, row, np.frexp(times.astype(float))[1])
    first = np.cumsum(bits) - bits
    total = int(bits.sum())
    plane, held = [], []
    for k in range(int(bits.max(initial=0))):
        some = (times >> k) & 1 == 1
        plane.append(first[row[some]] + k)
        held.append(number[some])
    plane = np.concatenate(plane) if plane else np.zeros(0, np.int64)
    held = np.concatenate(held) if held else np.zeros(0, np.int64)
    order = np.argsort(plane, kind="stable")
    plane, held = plane[order], held[order]
    cards = np.bincount(plane, minlength=total)
    starts = np.cumsum(cards) - cards
    plain_size = -(-documents // 8)
    plain = 2 * cards > plain_size
    sizes = 1 + np.where(plain, plain_size, 2 * cards)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    out = np.zeros(int(ends[-1]) if total else 0, np.uint8)
    out[begins] = np.where(plain, PLAIN, LISTED)
    some = ~plain[plane]
    at = (begins[plane] + 1 + 2 * (np.arange(len(plane)) - starts[plane]))[some]
    out[at], out[at + 1] = held[some] & 255, held[some] >> 8
    for c in np.flatnonzero(plain):
        marks = np.zeros(plain_size * 8, np.uint8)
        marks[held[starts[c] : starts[c] + cards[c]]] = 1
        out[begins[c] + 1 : ends[c]] = np.packbits(marks, bitorder="little")
    offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32))
    values = pa.Array.from_buffers(pa.binary(), total, [None, offsets, pa.py_buffer(out)])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(bits)]).astype(np.int32)), values)


def read_planes(planes: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, plane, document number) of every mark, by row, plane and number."""
    lists = planes.offsets.to_numpy().astype(np.int64)
    values = planes.flatten()
    bits = np.diff(lists)
    rows = np.repeat(np.arange(len(planes)), bits)
    ks = np.arange(len(values)) - np.repeat(lists[:-1] - lists[0], bits)
    at = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    begins, sizes = at[:-1], np.diff(at)
    plain = data[begins] == PLAIN if len(values) else np.zeros(0, bool)
    cards = np.where(plain, 0, (sizes - 1) // 2)
    found = {int(c): np.flatnonzero(np.unpackbits(data[at[c] + 1 : at[c + 1]], bitorder="little")) for c in np.flatnonzero(plain)}
    for c, numbers in found.items():
        cards[c] = len(numbers)
    which = np.repeat(np.arange(len(values)), cards)
    starts = np.cumsum(cards) - cards
    number = np.zeros(len(which), np.int64)
    some = ~plain[which]
    place = (begins[which] + 1 + 2 * (np.arange(len(which)) - starts[which]))[some]
    number[some] = data[place] | (data[place + 1].astype(np.int64) << 8)
    for c, numbers in found.items():
        number[starts[c] : starts[c] + cards[c]] = numbers
    return rows[which], ks[which], number


def merged_documents(row: np.ndarray, number: np.ndarray, rows: int) -> np.ndarray:
    """How many documents the planes of each row have together: their OR, counted."""
    either = np.unique((row << 16) | number)
    return np.bincount(either >> 16, minlength=rows)


# Texts -------------------------------------------------------------------------------------------------


class _Batch:
    """Groups and links of the texts of a batch."""

    def __init__(self, a_coder, b_coder, texts: list[str | None]):
        self.a_bytes, self.b_bytes = a_coder.bytes, b_coder.bytes
        n = len(texts)
        self.counts = {c: np.zeros(n, np.int64) for c in COUNTS}
        self.groups = [""] * n
        given = [i for i, t in enumerate(texts) if t]
        a = [a_coder.ids(" " + texts[i], False).astype(np.int64) for i in given]
        b = b_coder.ids([texts[i] for i in given])
        b = [np.fromiter(ids, np.int64, len(ids)) for ids in b]
        good = self._equal(a_coder, a, given, texts) & self._equal(b_coder, b, given, texts)
        rows = np.array(given, np.int64)[good]
        a, b = ([ids for ids, ok in zip(side, good, strict=True) if ok] for side in (a, b))
        none = np.zeros(0, np.int64)
        self.a, self.b = (np.concatenate(side) if side else none for side in (a, b))
        a_row, b_row = (np.repeat(rows, [len(ids) for ids in side]) for side in (a, b))
        self._cut(a_row)
        for name, row in (("n_a", a_row), ("n_b", b_row), ("n_groups", self.row)):
            self.counts[name] = np.bincount(row, minlength=n)
        links = np.zeros(n, np.int64)
        np.add.at(links, self.row, self.a_size * self.b_size)
        self.counts["n_links"] = links
        for i, shown in zip(rows, self._shown(b_row), strict=True):
            self.groups[i] = shown

    @staticmethod
    def _equal(coder, ids: list[np.ndarray], given: list[int], texts: list[str | None]) -> np.ndarray:
        """Whether the bytes of the tokens are the text after a space."""
        want = [(" " + texts[i]).encode() for i in given]
        sizes = [int(coder.bytes.sizes[x].sum()) for x in ids]
        made = coder.bytes.joined(np.concatenate(ids)).tobytes() if ids else b""
        ends = np.cumsum(sizes)
        return np.array(
            [n == len(w) and made[e - n : e] == w for w, n, e in zip(want, sizes, ends, strict=True)], bool
        )

    def _cut(self, a_row: np.ndarray) -> None:
        """Groups end where tokens of both sides do; texts follow each other and always end together."""
        a_end, b_end = np.cumsum(self.a_bytes.sizes[self.a]), np.cumsum(self.b_bytes.sizes[self.b])
        ends = np.zeros(int(a_end[-1]) + 1 if len(a_end) else 1, np.uint8)
        ends[a_end] |= 1
        ends[b_end] |= 2
        self.a_last, self.b_last = ends[a_end] == 3, ends[b_end] == 3
        self.a_group = np.cumsum(self.a_last) - self.a_last
        self.b_group = np.cumsum(self.b_last) - self.b_last
        n = int(self.a_last.sum())
        self.a_size, self.b_size = np.bincount(self.a_group, minlength=n), np.bincount(self.b_group, minlength=n)
        self.a_start, self.b_start = np.cumsum(self.a_size) - self.a_size, np.cumsum(self.b_size) - self.b_size
        self.row = a_row[self.a_last]

    def _shown(self, b_row: np.ndarray) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of each text that has tokens."""
        if not len(self.a):
            return []
        out = np.empty(len(self.a) + len(self.b), object)
        tables = np.array([[n + s for n in self.a_bytes.names] for s in (",", "|")], object)
        out[np.arange(len(self.a)) + self.b_start[self.a_group]] = tables[self.a_last.astype(int), self.a]
        tables = np.array([[n + s for n in self.b_bytes.names] for s in (",", ";", "\n")], object)
        closes = np.append(b_row[1:] != b_row[:-1], True)
        place = np.arange(len(self.b)) + (self.a_start + self.a_size)[self.b_group]
        out[place] = tables[self.b_last.astype(int) + closes, self.b]
        return "".join(out.tolist()).split("\n")[:-1]

    def entries(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(pair, row, multiplicity) in parts, each pair and row once a part."""
        width = len(self.b_bytes)
        product = self.a_size * self.b_size
        # A group of a few tokens is written out; of a large one equal ids are counted first.
        small = product <= 8 * (self.a_size + self.b_size)
        mine = np.flatnonzero(small[self.a_group])
        group = self.a_group[mine]
        repeat = self.b_size[group]
        within = np.arange(int(repeat.sum())) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        pair = np.repeat(self.a[mine], repeat) * width + self.b[np.repeat(self.b_start[group], repeat) + within]
        yield _folded(pair, np.repeat(self.row[group], repeat), np.ones(len(pair), np.int64))
        parts, size = [], 0
        for g in np.flatnonzero(~small):
            a_ids, a_n = np.unique(self.a[self.a_start[g] : self.a_start[g] + self.a_size[g]], return_counts=True)
            b_ids, b_n = np.unique(self.b[self.b_start[g] : self.b_start[g] + self.b_size[g]], return_counts=True)
            step = max(1, BLOCK_ENTRIES // 4 // len(b_ids))
            for i in range(0, len(a_ids), step):
                pair = (a_ids[i : i + step, None] * width + b_ids).ravel()
                parts.append((pair, np.full(len(pair), self.row[g]), (a_n[i : i + step, None] * b_n).ravel()))
                size += len(pair)
                if size > BLOCK_ENTRIES // 4:
                    yield _folded(*map(np.concatenate, zip(*parts, strict=True)))
                    parts, size = [], 0
        if parts:
            yield _folded(*map(np.concatenate, zip(*parts, strict=True)))


def _folded(pair: np.ndarray, row: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each (pair, row) once, in order, with its multiplicities added."""
    key = (pair << 16) | row
    order = np.argsort(key)
    key, times = key[order], times[order]
    if not len(key):
        return pair, row, times
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    key = key[first]
    return key >> 16, key & 0xFFFF, np.add.reduceat(times, first)


# Tables ------------------------------------------------------------------------------------------------


def index(docs: DataFrame, a: Coder, b: Coder, text: str = "text") -> DataFrame:
    """The inverted index: rows `(block, number, doc, groups, n_a, n_b, n_groups, n_links, posting)`.

    Document rows hold the other columns as `doc`, whatever their names, their counts, and the groups
    as text. Posting rows hold `posting`: a pair of ids and its planes in the block. Store it before use: the
    numbers of documents hold for one run.

    Texts that are null or empty, or whose tokens on either side do not make up the text after a space, have no
    tokens: no groups, no links, counts of zero. Repeated rows are documents of their own. Whole texts are
    read, a few megabytes at a time; a block is closed when it has BLOCK_ROWS documents or, between two
    batches, BLOCK_ENTRIES pairs of documents.
    """
    keep = [c for c in docs.columns if c != text]
    doc = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(None).cast("int").alias("none"))
    first = docs.select(F.col(f"`{text}`").alias("text"), doc.alias("doc"))
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("number", T.IntegerType()),
            T.StructField("doc", first.schema["doc"].dataType),
            T.StructField("groups", T.StringType()),
            *[T.StructField(c, T.LongType()) for c in COUNTS],
            T.StructField("posting", POSTING),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_coder, b_coder = a.load(), b.load()
        block, rows, pending, doc_type = TaskContext.get().partitionId() << 32, 0, [], None
        for batch in sized(batches, 0, BATCH_BYTES):
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                doc_type = part.column(1).type
                if rows + part.num_rows > BLOCK_ROWS or sum(len(p[0]) for p in pending) > BLOCK_ENTRIES:
                    yield from _postings(block, rows, pending, doc_type, len(b_coder.bytes))
                    block, rows, pending = block + 1, 0, []
                made = _Batch(a_coder, b_coder, part.column(0).to_pylist())
                numbers = np.arange(rows, rows + part.num_rows)
                yield _rows(
                    block,
                    part.num_rows,
                    number=pa.array(numbers, pa.int32()),
                    doc=part.column(1),
                    groups=pa.array(made.groups, pa.string()),
                    **{c: pa.array(v.astype(np.int64)) for c, v in made.counts.items()},
                    posting=pa.nulls(part.num_rows, POSTING_ARROW),
                )
                for pair, row, times in made.entries():
                    pending.append((pair, row + rows, times))
                    if sum(len(p[0]) for p in pending) > 2 * BLOCK_ENTRIES:
                        # Only one batch with huge groups comes here; what it repeats is folded.
                        pending = [_folded(*map(np.concatenate, zip(*pending, strict=True)))]
                rows += part.num_rows
        if rows:
            yield from _postings(block, rows, pending, doc_type, len(b_coder.bytes))

    return first.mapInArrow(run, schema)


POSTING_ARROW = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("planes", pa.list_(pa.binary()))])


def _rows(block: int, n: int, **columns: pa.Array) -> pa.RecordBatch:
    made = {"block": pa.array(np.full(n, block)), **columns}
    return pa.RecordBatch.from_arrays(list(made.values()), list(made))


def _postings(block: int, documents: int, pending: list, doc_type: pa.DataType, width: int) -> Iterator[pa.RecordBatch]:
    """The postings of a finished block."""
    pair, number, times = _folded(*map(np.concatenate, zip(*pending, strict=True)))
    starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    bounds = np.append(starts, len(pair))
    for at in range(0, len(starts), ROWS):
        lo, hi = bounds[at], bounds[min(at + ROWS, len(starts))]
        sizes = np.diff(bounds[at : at + ROWS + 1])
        row = np.repeat(np.arange(len(sizes)), sizes)
        planes = write_planes(row, number[lo:hi], times[lo:hi], len(sizes), documents)
        ids = pair[starts[at : at + ROWS]]
        fields = [pa.array(ids // width, pa.int32()), pa.array(ids % width, pa.int32()), planes]
        n = len(sizes)
        yield _rows(
            block,
            n,
            number=pa.nulls(n, pa.int32()),
            doc=pa.nulls(n, doc_type),
            groups=pa.nulls(n, pa.string()),
            **{c: pa.nulls(n, pa.int64()) for c in COUNTS},
            posting=pa.StructArray.from_arrays(fields, ["a", "b", "planes"]),
        )


def pair_counts(stored_index: DataFrame) -> DataFrame:
    """`(a, b, n_docs, n_links)`: in how many documents two ids are linked, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            row, plane, number = read_planes(batch.column(2))
            links = np.zeros(n, np.int64)
            np.add.at(links, row, np.int64(1) << plane)
            docs = merged_documents(row, number, n)
            made = [batch.column(0), batch.column(1), pa.array(docs), pa.array(links)]
            yield pa.RecordBatch.from_arrays(made, ["a", "b", "n_docs", "n_links"])

    postings = stored_index.where("posting IS NOT NULL").select("posting.a", "posting.b", "posting.planes")
    counted = postings.mapInArrow(run, "a int, b int, n_docs bigint, n_links bigint")
    return counted.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))


def scores(stored_index: DataFrame, counts: DataFrame) -> DataFrame:
    """`(block, number, n_best, count_sum)` of documents with links: how many of a document's links have the
    count that is the highest of their first id, and the sum of the counts of its links."""
    # Groups of this window are the ids of one vocabulary.
    highest = F.max("n_docs").over(Window.partitionBy("a"))
    best = counts.select("a", "b", "n_docs", (F.col("n_docs") == highest).alias("best"))
    postings = stored_index.where("posting IS NOT NULL").select("block", "posting.a", "posting.b", "posting.planes")
    met = postings.join(best, ["a", "b"]).select("block", "n_docs", "best", "planes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            row, plane, number = read_planes(batch.column(3))
            weight = np.int64(1) << plane
            counted = weight * batch.column(1).to_numpy()[row]
            weight = weight * batch.column(2).to_numpy(zero_copy_only=False)[row]
            # Rows come sorted by block: all but the last block of a batch are finished.
            edges = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(blocks) else []
            for block, lo, hi in zip(blocks[edges], edges, [*edges[1:], len(blocks)], strict=True):
                for done in [b for b in sums if b != block]:
                    yield finished(done, *sums.pop(done))
                best_n, total = sums.setdefault(int(block), (np.zeros(BLOCK_ROWS, np.int64), np.zeros(BLOCK_ROWS, np.int64)))
                some = slice(*np.searchsorted(row, [lo, hi]))
                np.add.at(best_n, number[some], weight[some])
                np.add.at(total, number[some], counted[some])
        for block, held in sums.items():
            yield finished(block, *held)

    def finished(block: int, best_n: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        some = np.flatnonzero(total)
        return _rows(
            block,
            len(some),
            number=pa.array(some, pa.int32()),
            n_best=pa.array(best_n[some]),
            count_sum=pa.array(total[some]),
        )

    by_block = met.repartition("block").sortWithinPartitions("block")
    return by_block.mapInArrow(run, "block bigint, number int, n_best bigint, count_sum bigint")


def scored_documents(stored_index: DataFrame) -> DataFrame:
    """Every document of a stored index: `doc`, `groups`, its counts, `n_best` and `count_sum`."""
    counts = stored(pair_counts(stored_index), "pair_counts")
    documents = stored_index.where("number IS NOT NULL").drop("posting")
    found = documents.join(scores(stored_index, counts), ["block", "number"], "left")
    filled = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("n_best", "count_sum")]
    return found.select("doc", "groups", *COUNTS, *filled)


def align(docs: DataFrame, a: Coder, b: Coder, text: str = "text") -> DataFrame:
    """One row per document: see `index` and `scored_documents`."""
    return scored_documents(stored(index(docs, a, b, text), "alignment"))

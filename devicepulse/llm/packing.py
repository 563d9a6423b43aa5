"""Packing token sequences by exact complements.

Documents are cut into pieces of at most `capacity` tokens. Which lengths go together is decided on the
number of pieces of each length alone, `capacity` numbers whatever the corpus. Sums of one, two and three
lengths that are still to be had are indexed by their value. The largest piece left opens a sequence; a
length, pair or triple whose sum is exactly the gap closes it, largest first, and where there is none the
largest piece that fits goes in and the rest of the gap is looked up again. The combination found is used as
often as the counts of its lengths allow, so there are a few combinations for each length.

Each piece has a rank among those of its length: its place in its partition plus what earlier partitions
hold. Ranks are dealt to the places of the combinations, so no task sees all pieces of a length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicepulse.llm.coders import Coder
from devicepulse.llm.common import sized, stored

CAPACITY = 1024
END = 2
BATCH_BYTES = 4 << 20


def cut(
    docs: DataFrame, coder: Coder, text: str = "text", capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """A row per piece: the other columns, `piece` (from 0), `start`, `length` and `tokens`, the ids as
    unsigned 32-bit numbers, little-endian.

    A document is its token ids and `end`; a null or empty text is `end` alone. Up to `capacity` tokens are
    one piece; longer documents are cut so that all pieces but the first are full. Whole texts are
    encoded, a few megabytes at a time; strings of special tokens count as such. Repeated rows are cut each.
    A column that has the name of a made one is replaced.
    """
    made = {
        "piece": T.IntegerType(),
        "start": T.LongType(),
        "length": T.LongType(),
        "tokens": T.BinaryType(),
    }
    keep = [c for c in docs.columns if c not in made and c != text]
    first = docs.select(F.col(f"`{text}`"), *[F.col(f"`{c}`") for c in keep])
    schema = T.StructType(first.schema.fields[1:] + [T.StructField(n, t) for n, t in made.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = coder.load()
        closing = np.array([end], np.uint32)
        for batch in sized(batches, 0, BATCH_BYTES):
            parts = []
            for t in batch.column(0).to_pylist():
                parts += [vocabulary.ids(t, True), closing] if t else [closing[:0], closing]
            sizes = np.array([len(p) for p in parts], np.int64).reshape(-1, 2).sum(1)
            flat = np.concatenate(parts).astype("<u4", copy=False)
            pieces = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            opening = (sizes - (pieces - 1) * capacity)[row]
            start = np.where(piece == 0, 0, opening + (piece - 1) * capacity)
            length = np.where(piece == 0, opening, capacity)
            offsets = pa.py_buffer(np.concatenate([[0], np.cumsum(length) * 4]).astype(np.int32))
            tokens = pa.Array.from_buffers(pa.binary(), len(row), [None, offsets, pa.py_buffer(flat)])
            columns = [batch.column(i).take(pa.array(row)) for i in range(1, batch.num_columns)]
            columns += [pa.array(piece, pa.int32()), pa.array(start), pa.array(length), tokens]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return first.mapInArrow(run, schema)


class Sums:
    """Which sums of one, two or three lengths can be had, by their value, as lengths run out.

    `one`, `two` and `three` count the ordered ways to reach a sum from lengths of which any is left.
    """

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self.one = np.zeros(len(counts), np.int64)
        self.two = np.zeros(len(counts), np.int64)
        self.three = np.zeros(len(counts), np.int64)
        for x in np.flatnonzero(self.left):
            self._ways(int(x), 1)
            self.one[x] = 1

    def _ways(self, x: int, sign: int) -> None:
        """Add or take off all sums with `x`, which `one` does not hold now."""
        size = len(self.one)

        def at(sums: np.ndarray, shift: int) -> np.ndarray:
            out = np.zeros(size, np.int64)
            if shift < size:
                out[shift:] = sums[: size - shift]
            return out

        nothing = np.zeros(size, np.int64)
        nothing[0] = 1
        if sign < 0:
            self.two -= 2 * at(self.one, x) + at(nothing, 2 * x)
        self.three += sign * (3 * at(self.two, x) + 3 * at(self.one, 2 * x) + at(nothing, 3 * x))
        if sign > 0:
            self.two += 2 * at(self.one, x) + at(nothing, 2 * x)

    def take(self, lengths: Counter, times: int) -> None:
        for x, uses in lengths.items():
            self.left[x] -= uses * times
            if self.left[x] == 0:
                self.one[x] = 0
                self._ways(x, -1)

    def _pair(self, free: np.ndarray, total: int, most: int) -> tuple[int, int] | None:
        """Two lengths of that sum, the larger one at most `most` and as large as can be."""
        if total < 2 or not self.two[total]:
            return None
        larger = np.arange(min(most, total - 1), (total - 1) // 2, -1)
        smaller = total - larger
        good = (free[larger] > 0) & (free[smaller] > (larger == smaller))
        found = np.flatnonzero(good)
        return (int(larger[found[0]]), int(smaller[found[0]])) if len(found) else None

    def exactly(self, gap: int, used: Counter) -> tuple[int, ...] | None:
        """One, two or three lengths that fill the gap, beside those already used in the sequence."""
        free = self.left
        if used:
            free = free.copy()
            for x, n in used.items():
                free[x] -= n
        if free[gap] > 0:
            return (gap,)
        pair = self._pair(free, gap, gap)
        if pair or gap < 3 or not self.three[gap]:
            return pair
        for x in range(gap - 2, (gap - 1) // 3, -1):
            if free[x] > 0 and self.two[gap - x]:
                free_now = free.copy()
                free_now[x] -= 1
                rest = self._pair(free_now, gap - x, x)
                if rest:
                    return (x, *rest)
        return None

    def largest(self, most: int, used: Counter) -> int | None:
        """The largest length of at most `most` that is left."""
        for x in np.flatnonzero(self.one[: most + 1])[::-1]:
            if self.left[x] > used[int(x)]:
                return int(x)
        return None


def combinations(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Lengths that share a sequence, and how many sequences have them; uses up all of `counts`, the number
    of pieces by length."""
    sums, out = Sums(counts), []
    while True:
        opening = sums.largest(capacity, Counter())
        if opening is None:
            return out
        lengths, gap = [opening], capacity - opening
        while gap:
            used = Counter(lengths)
            more = sums.exactly(gap, used)
            if more is None:
                best = sums.largest(gap, used)
                if best is None:
                    break
                more = (best,)
            lengths += more
            gap -= sum(more)
        used = Counter(lengths)
        times = min(int(sums.left[x]) // n for x, n in used.items())
        sums.take(used, times)
        out.append((tuple(lengths), times))


def _places(found: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """Per length and range of ranks, in order: length, first rank, first sequence, offset."""
    rank, sequence, rows = np.zeros(capacity + 1, np.int64), 0, []
    for lengths, times in found:
        offset = 0
        for x in lengths:
            rows.append((x, int(rank[x]), sequence, offset))
            rank[x] += times
            offset += x
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return tuple(table.T.copy())


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """Add `sequence_id` and `offset` to pieces of 1 to `capacity` tokens; columns of these names are
    replaced. Every sequence holds at most `capacity` tokens, without gaps.

    The pieces are stored first, so give slim rows. Pieces of equal length may be any share of all
    of them. Which of them goes where, and the numbers, may differ between runs; how many sequences there are
    does not. Pieces with a null length or one out of bounds fail the query.
    """
    keep = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    size = F.col(f"`{length}`").cast("bigint")
    checked = F.when(size.between(1, capacity), size).otherwise(
        F.raise_error(F.lit(f"a piece must have 1 to {capacity} tokens")).cast("bigint")
    )
    given = F.struct(*[F.col(f"`{c}`") for c in keep])
    rows = pieces.select(given.alias("given"), checked.alias("size"), F.monotonically_increasing_id().alias("at"))
    rows = stored(rows, "pieces").withColumn("part", F.shiftright("at", 33))
    per_part = rows.groupBy("size", "part").agg(F.count("*").alias("n"))
    # One row per length: at most `capacity`.
    held = per_part.groupBy("size").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in held:
        counts[row["size"]] = row["n"]
    lengths, firsts, sequences, offsets = _places(combinations(counts, capacity), capacity)
    span = int(counts.sum()) + 1
    keys = lengths * span + firsts

    schema = T.StructType(
        [rows.schema["given"], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(2).to_numpy()
            at = np.searchsorted(keys, batch.column(1).to_numpy() * span + rank, side="right") - 1
            made = [pa.array(sequences[at] + rank - firsts[at]), pa.array(offsets[at])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], schema.names)

    # Groups of this window are parts of one partition; the next one runs over partitions, not rows.
    inside = F.row_number().over(Window.partitionBy("size", "part").orderBy("at")).cast("bigint") - 1
    earlier = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select("size", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = rows.withColumn("inside", inside).join(before, ["size", "part"])
    placed = ranked.select("given", "size", (F.col("before") + F.col("inside")).alias("rank")).mapInArrow(place, schema)
    return placed.select("given.*", "sequence_id", "offset")

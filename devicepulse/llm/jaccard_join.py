"""N-gram Jaccard join by a prefix tree, and the groups that its links form.

A text's set is its distinct word n-grams, as 62-bit hashes in one global order: n-grams known to be frequent
come last. Equal sets are one node from the start. Two sets that reach the threshold share an n-gram in the
first few of both, the prefixes, so candidates meet on those; nothing else of a set is moved for that.
Candidates are compared in small blocks: the sets of a block go into a tree of their ordered n-grams,
where sets that begin alike share a path, a probe set walks it adding up the overlap once for all sets
below a node, and a branch is left as soon as what remains of its sets cannot reach the threshold.

Groups of thousands of near copies never come out as pairs. Sets that meet one centre on a good part of
their prefixes form a family. A family is cut into parts of a bounded number of sets, and every two parts
go through a tree together, in one task, where all probes walk the tree at once, their overlaps counted by bits;
out come only the links that join groups, and counts. Candidates
of different families are few; they come as pairs, counted over all n-grams of their prefixes, which gives a
bound on their overlap, and the ones that pass it are compared in trees too. So no link is lost.

Near copies meet again and again in the same company: n-grams that the same sets hold are one row with their
number from the shuffle of the prefixes on. Families move as texts, which are shorter than their sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devicepulse.llm.common import SPACES, sized, stored
from devicepulse.operators.dedup import key_filter, may_hold

BATCH_BYTES = 4 << 20
KEY_BITS = 16  # of a filter, for each key in it
MOST_BITS = 1 << 26  # of a filter: 8 MB in every task
PART_GRAMS = 4 << 20  # of a part of a family, about
PROBE_BYTES = 32 << 20  # of the bitmaps that walk a tree together
GROUP_CHARS = 1 << 19  # of the texts whose sets are made at once, so that their arrays stay small
PIECE = 1 << 16  # bytes hashed at once
LONG_WORD = 64  # bytes, far below the words whose sums could agree by their pattern alone
HEAVY = np.uint64(1 << 62)
LOW_BITS = np.uint64((1 << 62) - 1)


@dataclass(frozen=True)
class Join:
    """Sets of `width`-word n-grams link where share * |union| <= 100 * |intersection|.

    A shorter text is one n-gram of all its words. `frequent` is how many frequent n-grams are known at
    most; they only decide the order, so a bound on them costs time, never a link.
    """

    width: int = 5
    share: int = 80
    frequent: int = 1_000_000
    star_edges: int = 3
    block_sets: int = 512

    def prefix(self, n):
        """How many of a set's first n-grams any set that reaches the threshold shares one of."""
        return n - (-(-self.share * n // 100)) + 1

    def needed(self, a, b):
        """The overlap at which sets of sizes a and b link."""
        return -(-self.share * (a + b) // (100 + self.share))


def _powers(base: int) -> np.ndarray:
    return np.cumprod(np.array([1, *[base] * (PIECE - 1)], np.uint64))


class _Words:
    """Hashes of the words of texts, all words of a piece of bytes at once.

    A word is a sum of its bytes' random numbers, each times a power of an odd base by its place in the word. Sums up
    to every byte of a piece give that of each word, and the base's inverse takes the word to the same place. Long
    words are hashed one by one.
    """

    BASE = 0x9FB21C651E98DF25
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self):
        self.numbers = np.random.default_rng(0x5E7).integers(0, 1 << 64, 256, np.uint64, endpoint=False)
        self.spaces = np.zeros(256, bool)
        self.spaces[list(b" \t\n\r\x0b\x0c")] = True
        self.powers, self.inverses = _powers(self.BASE), _powers(self.INVERSE)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Words in order, and where each text's words begin, with the end. Only A-Z are lower-cased, and words
        end at ASCII white space, as `bytes` has both."""
        raw = [t.encode() if t else b"" for t in texts]
        data = np.frombuffer(b"\n".join([*raw, b""]).lower(), np.uint8)
        space = self.spaces[data]
        inside = ~space
        inside[1:] &= space[:-1]
        starts = np.flatnonzero(inside)
        inside = ~space[:-1]
        inside &= space[1:]
        ends = np.flatnonzero(inside) + 1
        begin = np.cumsum([0, *[len(r) + 1 for r in raw]])
        words = np.zeros(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            to = int(np.searchsorted(ends, starts[at] + PIECE, side="right"))
            if to > at:
                piece = data[starts[at] : ends[to - 1]]
                words[at:to] = self._piece(piece, starts[at:to] - starts[at], ends[at:to] - starts[at])
            at = max(to, at + 1)  # a word over the size is a long one
        for at in np.flatnonzero(ends - starts > LONG_WORD).tolist():
            words[at] = xxhash.xxh3_64_intdigest(data[starts[at] : ends[at]])
        return words, np.searchsorted(starts, begin)

    def _piece(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.numbers[data] * self.powers[: len(data)], out=sums[1:])
        words = (sums[ends] - sums[starts]) * self.inverses[starts]
        # The low bits of a sum know only the low bits of the numbers.
        words ^= words >> np.uint64(32)
        words *= np.uint64(0xD6E8FEB86659FD93)
        words ^= words >> np.uint64(32)
        return words


class _Shingler:
    """Sets of texts, with the frequent n-grams at hand."""

    def __init__(self, join: Join, frequent: np.ndarray | None = None):
        self.join, self.words = join, _Words()
        self.frequent = frequent if frequent is not None and len(frequent) else None
        if self.frequent is not None:
            # By the high bits, so that few others are looked for.
            self.maybe = np.zeros(1 << 23, bool)
            self.maybe[self.frequent >> np.uint64(39)] = True

    def __call__(self, text: str | None) -> np.ndarray:
        """The set in global order; empty for a text without words."""
        return self.keyed([text])[0][1]

    def keyed(self, texts: list[str | None]) -> list[tuple[bytes, np.ndarray]]:
        """(key, set in global order) of each text. The key is a digest of the set, whatever is known to be
        frequent. 96 bits, as keys are most of what is moved."""
        made, some, held = [], [], 0
        for text in texts:
            some.append(text)
            held += len(text or "")
            if held >= GROUP_CHARS:
                made += self._keyed(some)
                some, held = [], 0
        return made + self._keyed(some)

    def _keyed(self, texts: list[str | None]) -> list[tuple[bytes, np.ndarray]]:
        words, at = self.words(texts)
        full = self._mixed(words, self.join.width)
        sets = []
        for begin, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            width = min(self.join.width, end - begin)
            made = full[begin : end - width + 1] if width == self.join.width else self._mixed(words[begin:end], width)
            made.sort()
            different = made[1:] != made[:-1]
            sets.append(made if different.all() else made[np.concatenate([[True], different])])
        keys = [blake2b(made, digest_size=12).digest() for made in sets]
        if self.frequent is None:
            return list(zip(keys, sets, strict=True))
        flat = np.concatenate([np.empty(0, np.uint64), *sets])
        heavy = self.maybe[flat >> np.uint64(39)]
        found = np.flatnonzero(heavy)
        place = np.searchsorted(self.frequent, flat[found]).clip(max=len(self.frequent) - 1)
        heavy[found] = self.frequent[place] == flat[found]
        done, begin = [], 0
        for made in sets:
            last = heavy[begin : begin + len(made)]
            begin += len(made)
            done.append(np.concatenate([made[~last], made[last] | HEAVY]) if last.any() else made)
        return list(zip(keys, done, strict=True))

    def _mixed(self, words: np.ndarray, width: int) -> np.ndarray:
        """The hash of every `width` words in a row."""
        if not width:
            return np.empty(0, np.uint64)
        mixed = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for i in range(width):
            mixed += words[i : i + len(mixed)]
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
        # A whole short text is no n-gram of a longer one.
        mixed ^= np.uint64((self.join.width - width) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        mixed &= LOW_BITS
        return mixed


def _pass(docs: DataFrame, join: Join, frequent, make, schema: str) -> DataFrame:
    """Run `make(shingler, batch)` over (id, mark, text) batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if frequent is None else np.frombuffer(frequent.value, np.uint64)
        shingler, state = _Shingler(join, known), {}
        for batch in sized(batches, 2, BATCH_BYTES):
            yield from make(shingler, batch, state)

    return docs.mapInArrow(run, schema)


def _nodes(shingler: _Shingler, batch: pa.RecordBatch, state: dict) -> Iterator[pa.RecordBatch]:
    """A row for each document, and one for each n-gram that two or more of the batch's sets hold."""
    made = shingler.keyed(batch.column(2).to_pylist())
    sets = [s for _, s in made]
    keys = [k if len(s) else None for k, s in made]
    different = {k: s for k, s in made if len(s)}
    tokens, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *different.values()]), return_counts=True)
    tokens, counts = tokens[counts > 1].astype(np.int64), counts[counts > 1]
    n, m = len(sets), len(tokens)
    yield pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([batch.column(0), pa.nulls(m, pa.int64())]),
            pa.concat_arrays([batch.column(1), pa.nulls(m, pa.int64())]),
            pa.concat_arrays([pa.array(keys, pa.binary()), pa.nulls(m, pa.binary())]),
            pa.array([len(s) for s in sets] + counts.tolist(), pa.int64()),
            pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(tokens)]),
        ],
        ["id", "mark", "key", "n", "token"],
    )


def _prefixes(shingler: _Shingler, batch: pa.RecordBatch, state: dict) -> Iterator[pa.RecordBatch]:
    """(key, token) for the prefix of each set; in that order both lie side by side in Spark's rows, which compress
    better so. Copies in a task come out once, as far as it remembers."""
    seen = state.setdefault("seen", set())
    tokens, keys = [], []
    for key, made in shingler.keyed(batch.column(2).to_pylist()):
        if not len(made) or key in seen:
            continue
        if len(seen) >= 200_000:
            seen.clear()
        seen.add(key)
        first = made[: shingler.join.prefix(len(made))]
        tokens.append(first)
        keys.append((key, len(first)))
    if tokens:
        flat = np.concatenate(tokens).astype(np.int64)
        index = np.repeat(np.arange(len(keys), dtype=np.int32), [n for _, n in keys])
        names = pa.DictionaryArray.from_arrays(pa.array(index), pa.array([k for k, _ in keys], pa.binary()))
        yield pa.RecordBatch.from_arrays([names.dictionary_decode(), pa.array(flat)], ["key", "token"])


def _sets(shingler: _Shingler, batch: pa.RecordBatch, state: dict) -> Iterator[pa.RecordBatch]:
    """(key, tokens, ...): whole sets, as big-endian numbers, whose byte order is their order; what follows the text
    is handed on. Repeated rows in a task come out once, as far as it remembers."""
    seen = state.setdefault("seen", set())
    rows, keys, tokens = [], [], []
    for i, (key, made) in enumerate(shingler.keyed(batch.column(2).to_pylist())):
        if key in seen:
            continue
        if len(seen) >= 200_000:
            seen.clear()
        seen.add(key)
        rows.append(i)
        keys.append(key)
        tokens.append(made.astype(">u8").tobytes())
    take, names = pa.array(rows, pa.int32()), batch.schema.names[3:]
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(tokens, pa.binary()), *[batch.column(c).take(take) for c in names]],
        ["key", "tokens", *names],
    )


def walk_tree(rows: list[tuple[bytes, bytes]], probe: bytes, join: Join) -> Iterator[bytes]:
    """The keys among (key, tokens) rows whose sets link with the probe set.

    Rows in byte order are the leaves of a tree: rows lo to hi that agree in their first `depth` tokens are
    a node. The overlap of a node's stretch of tokens with the probe is counted once for all below.
    """
    rows = sorted(rows, key=lambda r: r[1])
    sets = [np.frombuffer(r[1], ">u8").astype(np.uint64) for r in rows]
    wanted = np.frombuffer(probe, ">u8").astype(np.uint64)
    sizes = np.array([len(s) for s in sets])
    if not len(wanted) or not len(sets):
        return
    stack = [(0, len(sets), 0, 0)]
    while stack:
        lo, hi, depth, overlap = stack.pop()
        first, last = sets[lo], sets[hi - 1]
        # In order, what the first and the last share all between them share.
        n = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:n] != last[depth:n])
        end = depth + int(differ[0]) if len(differ) else n
        stretch = first[depth:end]
        if len(stretch):
            at = np.searchsorted(wanted, stretch).clip(max=len(wanted) - 1)
            overlap += int((wanted[at] == stretch).sum())
        passed = int(np.searchsorted(wanted, stretch[-1], side="right")) if len(stretch) else 0
        below = sizes[lo:hi]
        # The most that the rest of either side can add, against the least that a set below needs.
        most = overlap + np.minimum(below - end, len(wanted) - passed)
        if (most < join.needed(below, len(wanted))).all():
            continue
        if hi - lo == 1 or end == len(last):
            for i in range(lo, hi):
                if overlap >= join.needed(int(sizes[i]), len(wanted)):
                    yield rows[i][0]
            continue
        at = lo
        while at < hi and len(sets[at]) == end:  # ends here
            if overlap >= join.needed(int(sizes[at]), len(wanted)):
                yield rows[at][0]
            at += 1
        while at < hi:
            token, begin = sets[at][end], at
            while at < hi and sets[at][end] == token:
                at += 1
            stack.append((begin, at, end, overlap))


def walk_tree_together(
    rows: list[np.ndarray], probes: list[np.ndarray], join: Join, same: bool = False
) -> Iterator[tuple[int, np.ndarray]]:
    """For each of the sets `rows`, in their tree's order, which of the sets `probes` link with it. With `same`,
    both are the same sets in the same order, and every two of them come once.

    The tree is that of `walk_tree`, and all probes walk it together: an n-gram that sets of both sides hold is a bit,
    so that a node's stretch is counted for all its probes by the bits that they share. A node keeps the probes
    that can still reach the threshold with a set below.
    """
    order = np.array(sorted(range(len(rows)), key=lambda i: rows[i].astype(">u8").tobytes()), np.int64)
    sizes, wanted = (np.array([len(s) for s in side], np.int64) for side in (rows, probes))
    flat, own = np.concatenate([np.empty(0, np.uint64), *rows]), np.cumsum([0, *sizes])
    if same:
        bits, held = np.unique(flat, return_counts=True)
        bits = bits[held > 1]
    else:
        bits = np.intersect1d(flat, np.concatenate([np.empty(0, np.uint64), *probes]))
    if not len(bits):
        return

    def places(tokens: np.ndarray) -> np.ndarray:
        """The bits of n-grams; -1 for one that has none."""
        at = np.searchsorted(bits, tokens).clip(max=len(bits) - 1)
        return np.where(bits[at] == tokens, at, -1)

    of_rows = places(flat)
    # n-grams with a bit in the rest of a set: the most that the rest can add.
    rest = np.concatenate([np.cumsum((of_rows >= 0)[::-1])[::-1], [0]])
    words = (len(bits) + 63) // 64
    step = max(1, PROBE_BYTES // (8 * words))
    for begin in range(0, len(probes), step):
        some = probes[begin : begin + step]
        n = wanted[begin : begin + step]
        at = places(np.concatenate([np.empty(0, np.uint64), *some]))
        holder = np.repeat(np.arange(len(some)), n)[at >= 0]
        at = at[at >= 0]
        held = np.zeros((words, len(some)), np.uint64)
        np.add.at(held, (at >> 6, holder), np.uint64(1) << (at & 63).astype(np.uint64))
        most = np.bincount(holder, minlength=len(some))
        # (first, last, depth, probes, their overlaps)
        stack = [(0, len(order), 0, np.arange(len(some)), np.zeros(len(some), np.int64))]
        while stack:
            lo, hi, depth, live, overlap = stack.pop()
            first, last = rows[order[lo]], rows[order[hi - 1]]
            below = order[lo:hi]
            if same:
                later = live + begin > below.min()
                live, overlap = live[later], overlap[later]
            # Sets below need the more the larger they are, and add at most what they have left.
            left = rest[own[below] + depth] - rest[own[below + 1]]
            able = np.minimum(overlap + left.max(), most[live]) >= join.needed(sizes[below].min(), n[live])
            live, overlap = live[able], overlap[able]
            if not len(live):
                continue
            end = min(len(first), len(last))
            differ = np.flatnonzero(first[depth:end] != last[depth:end])
            end = depth + int(differ[0]) if len(differ) else end
            stretch = of_rows[own[order[lo]] + depth : own[order[lo]] + end]
            stretch = stretch[stretch >= 0]
            if len(stretch):
                word = stretch >> 6
                new = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
                mask = np.add.reduceat(np.uint64(1) << (stretch & 63).astype(np.uint64), new)[:, None]
                word = word[new]
                shared = held[word] if len(live) == len(some) else held[word[:, None], live]
                overlap = overlap + np.bitwise_count(shared & mask).sum(axis=0, dtype=np.int64)
            at = lo
            while at < hi and len(rows[order[at]]) == end:  # ends here
                i = int(order[at])
                found = live[overlap >= join.needed(sizes[i], n[live])] + begin
                found = found[found > i] if same else found
                if len(found):
                    yield i, found
                at += 1
            while at < hi:
                token, start = rows[order[at]][end], at
                while at < hi and rows[order[at]][end] == token:
                    at += 1
                stack.append((start, at, end, live, overlap))


def _compare(blocks: DataFrame, join: Join) -> DataFrame:
    """Blocks (block, probe, key, tokens) to links (a, b). Rows of a block lie together, the probe first, and
    a block holds a bounded number of sets; a key that comes twice is one."""

    def links(held: dict[bytes, bytes], probe) -> list[tuple[bytes, bytes]]:
        return [(probe[0], key) for key in walk_tree(list(held.items()), probe[1], join)] if probe and held else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, probe, held = None, None, {}

        def made(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], ["a", "b"]
            )

        for batch in batches:
            found = []
            for block, first, key, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != now:
                    found += links(held, probe)
                    now, probe, held = block, None, {}
                if first:
                    probe = key, tokens
                else:
                    held[key] = tokens
            yield made(found)
        yield made(links(held, probe))

    laid = blocks.repartition("block").sortWithinPartitions("block", F.col("probe").desc())
    return laid.mapInArrow(run, "a binary, b binary")


def _once(docs: DataFrame) -> DataFrame:
    """(id, mark, text) without the rows that a task has seen, as far as it remembers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            rows = []
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if key not in seen:
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(key)
                    rows.append(i)
            yield batch.take(pa.array(rows, pa.int32()))

    return docs.mapInArrow(run, "id bigint, mark bigint, text string")


def _compare_parts(blocks: DataFrame, join: Join, frequent) -> DataFrame:
    """Blocks (block, side, key, text), of one part (side 0) or of two (1 and 2), to rows (a, b, n): the links that
    join groups within a block, with n null, and the number of links n of each set a, with b null. A key that
    comes twice is one."""

    def links(alone: dict[bytes, np.ndarray], first: dict[bytes, np.ndarray], second: dict[bytes, np.ndarray]):
        same = bool(alone)
        first, second = (alone, alone) if same else (first, second)
        rows, probes = list(first.values()), list(second.values())
        keys, shift = (list(first), 0) if same else ([*first, *second], len(first))
        group, counts = np.arange(len(keys)), np.zeros(len(keys), np.int64)
        joined = []
        for i, found in walk_tree_together(rows, probes, join, same):
            found = found + shift
            counts[i] += len(found)
            counts[found] += 1
            apart = found[group[found] != group[i]]
            # One of each other group joins it with this set's.
            for k in apart[np.unique(group[apart], return_index=True)[1]].tolist():
                joined.append((keys[i], keys[k], None))
                group[group == group[k]] = group[i]
        return joined + [(keys[k], None, int(counts[k])) for k in np.flatnonzero(counts).tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, ({}, {}, {})
        shingler = _Shingler(join, np.frombuffer(frequent.value, np.uint64))
        kinds = (pa.binary(), pa.binary(), pa.int64())

        def made(rows):
            columns = zip(*rows, strict=True) if rows else [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "n"])

        for batch in sized(batches, 3, BATCH_BYTES):
            found = []
            sets = shingler.keyed(batch.column(3).to_pylist())
            for block, side, key, (_, tokens) in zip(*(c.to_pylist() for c in batch.columns[:3]), sets, strict=True):
                if block != now:
                    found += links(*parts)
                    now, parts = block, ({}, {}, {})
                if key not in parts[side]:
                    parts[side][key] = tokens.copy()  # not the whole batch's
            yield made(found)
        yield made(links(*parts))

    laid = blocks.repartition("block").sortWithinPartitions("block")
    return laid.mapInArrow(run, "a binary, b binary, n bigint")


class _Corpus:
    """What the steps share: the documents, their nodes, and the frequent n-grams."""

    def __init__(self, docs: DataFrame, join: Join, doc_id: str, text: str):
        self.join, self.spark = join, docs.sparkSession
        text_col = F.col(f"`{text}`")
        self.docs = docs.select(
            F.col(f"`{doc_id}`").cast("bigint").alias("id"), F.xxhash64(text_col).alias("mark"), text_col.alias("text")
        )
        schema = "id bigint, mark bigint, key binary, n bigint, token bigint"
        both = stored(_pass(self.docs, join, None, _nodes, schema), "nodes")
        self.nodes = both.where("token IS NULL").drop("token")
        often = both.where("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n"))
        # The most frequent ones, as one sorted array of at most 8 MB.
        top = often.orderBy(F.col("n").desc(), "token").limit(join.frequent).select("token").toArrow()
        known = np.sort(top.column("token").to_numpy().astype(np.uint64))
        self.frequent = self.spark.sparkContext.broadcast(known.tobytes())

    def prefixes(self) -> DataFrame:
        """(token, key, centre) for every n-gram that the prefixes of several sets hold, by one shuffle. Copies in
        different tasks fold.

        A centre is the first set of an n-gram by a hash of the set, so that n-grams of like sets have the same.
        An n-gram's token is here a hash of all sets that hold it, so that n-grams of the same sets are the same.
        Should the hashes of others agree, more sets meet and none is lost.
        """
        made = _pass(self.docs, self.join, self.frequent, _prefixes, "key binary, token bigint")
        one = made.repartition("token").groupBy("token", "key").agg(F.lit(1).alias("_"))
        by_token = Window.partitionBy("token")
        several = F.max("key").over(by_token) != F.min("key").over(by_token)
        centre = F.min(F.struct(F.xxhash64("key").alias("draw"), "key")).over(by_token)
        holders = F.bit_xor(F.xxhash64("key")).over(by_token)
        placed = one.select(holders.alias("token"), "key", several.alias("_several"), centre["key"].alias("centre"))
        return placed.where("_several").drop("_several")

    def meetings(self) -> DataFrame:
        """The rows of `prefixes` once each, with their number m."""
        return stored(self.prefixes().groupBy("token", "key", "centre").agg(F.count("*").alias("m")), "meetings")

    def texts(self, keys: DataFrame) -> DataFrame:
        """(id, mark, text, key, ...) of some nodes, from one document of each, with the other columns of `keys`.
        Repeated rows of a document may give a text once for each task."""
        chosen = self.nodes.join(keys, "key").groupBy(*keys.columns).agg(F.min(F.struct("id", "mark")).alias("_doc"))
        chosen = chosen.select(F.col("_doc.id").alias("_id"), F.col("_doc.mark").alias("_mark"), *keys.columns)
        # Stored first, so that its size is known when the join is planned: a few rows need no shuffle of texts.
        chosen = stored(chosen, "chosen")
        same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
        return _once(self.texts_of(chosen)).join(chosen, same).select("id", "mark", "text", *keys.columns)

    def sets(self, keys: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
        """(key, tokens, ...) of some nodes, with the other columns of `keys`; stored in an order. Repeated rows of a
        document may give a set once for each task."""
        types = dict(keys.drop("key").dtypes)
        texts = self.texts(keys).select("id", "mark", "text", *types)
        schema = ", ".join(["key binary", "tokens binary", *[f"{c} {t}" for c, t in types.items()]])
        made = _pass(texts, self.join, self.frequent, _sets, schema)
        return stored(made.sortWithinPartitions(*order) if order else made, "sets")

    def texts_of(self, chosen: DataFrame) -> DataFrame:
        """The documents (_id, _mark) with their texts, and a few others: all others are left out at the scan, so that
        a join moves only the texts that it needs. With far more documents than a fourth of `MOST_BITS` more
        others pass, which costs disk and changes no result."""
        held = chosen.select(F.col("_id").alias("id"), F.col("_mark").alias("mark"))
        bits = min(MOST_BITS, 1 << max(16, (KEY_BITS * held.count()).bit_length()))
        return self.docs.where(may_hold(key_filter(held, ["id", "mark"], bits), ["id", "mark"], bits))

    def compare(self, pairs: DataFrame) -> DataFrame:
        """The links (a, b) among candidate pairs (a, b)."""
        pairs = stored(pairs.select("a", "b"), "pairs")
        sets = self.sets(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct())
        counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / self.join.block_sets).alias("_blocks"))
        part = F.pmod(F.xxhash64("b"), F.col("_blocks"))
        cut = stored(pairs.join(counts, "a").select("a", "b", F.xxhash64("a", part).alias("block")), "cut")
        held = cut.join(sets, cut["b"] == sets["key"]).select("block", F.lit(False).alias("probe"), "key", "tokens")
        probes = cut.select("block", "a").distinct()
        probes = probes.join(sets, probes["a"] == sets["key"]).select("block", F.lit(True).alias("probe"), "key", "tokens")
        return stored(_compare(held.unionByName(probes), self.join), "links")

    def compare_families(self, families: DataFrame) -> DataFrame:
        """Families (key, label) to rows (a, b, n) as of `_compare_parts`, over all pairs of a family."""
        sizes = self.nodes.groupBy("key").agg(F.first("n").alias("n")).join(families, "key")
        # Long sets are fewer in a part.
        needed = F.greatest(F.count("*") / (4 * self.join.block_sets), F.sum("n") / PART_GRAMS)
        parts = sizes.groupBy("label").agg(F.ceil(needed).alias("_parts"))
        part = F.pmod(F.xxhash64("key"), F.col("_parts"))
        # Texts go straight to their blocks, and become sets there. Like texts lie together for that, so that
        # compression folds what near copies share.
        placed = self.texts(families.join(parts, "label").withColumn("_part", part)).drop("id", "mark")
        placed = stored(placed.sortWithinPartitions("label", "text"), "family_texts")
        both = placed.withColumn("_with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)))
        low, high = F.least("_part", "_with"), F.greatest("_part", "_with")
        # A part may hold nothing, so a block says whether it is of one part (0) or of two (1, 2).
        side = F.when(low == high, 0).when(F.col("_part") == low, 1).otherwise(2)
        blocks = both.select(F.xxhash64("label", low, high).alias("block"), side.alias("side"), "key", "text")
        return stored(_compare_parts(blocks, self.join, self.frequent), "family_links")


def _components(links: DataFrame) -> DataFrame:
    """(key, label) for every node of the links (a, b): the smallest key reachable.

    Every node takes the smallest label around it, then that label's own label, until nothing changes; so
    long chains shorten by half at least every round. Each round is a stored table, counts only reach the driver.
    """
    both = links.select(F.col("a").alias("key"), F.col("b").alias("near")).union(links.select("b", "a"))
    edges = stored(both.distinct(), "edges")
    labels = stored(edges.groupBy("key").agg(F.least(F.col("key"), F.min("near")).alias("label")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("key", "near"), "near").groupBy("key").agg(F.min("label").alias("seen"))
        hop = labels.select(F.col("key").alias("label"), F.col("label").alias("further"))
        moved = (
            labels.join(near, "key")
            .join(hop, "label", "left")
            .select("key", F.least("label", "seen", "further").alias("next"), "label")
        )
        moved = stored(moved, "labels")
        if moved.where("next <> label").isEmpty():
            return labels
        labels = moved.select("key", F.col("next").alias("label"))


def _needed(join: Join, a: Column, b: Column) -> Column:
    return F.ceil(F.lit(join.share) * (a + b) / F.lit(100 + join.share))


def _grouped(docs: DataFrame, join: Join, doc_id: str, text: str) -> DataFrame:
    """(id, mark, n, group, n_links) of every row; group is null for a text without words."""
    corpus = _Corpus(docs, join, doc_id, text)
    sizes = corpus.nodes.where("key IS NOT NULL").groupBy("key").agg(F.first("n").alias("n"))
    shared = corpus.meetings()
    n = stored(sizes.join(shared.select("key").distinct(), "key", "left_semi"), "sizes")
    fit = lambda x, y: (100 * x >= join.share * y) & (100 * y >= join.share * x)

    def with_sizes(pairs: DataFrame) -> DataFrame:
        a, b = n.select(F.col("key").alias("a"), F.col("n").alias("n_a")), n.select(F.col("key").alias("b"), F.col("n").alias("n_b"))
        return pairs.join(a, "a").join(b, "b").where(fit(F.col("n_a"), F.col("n_b")))

    by_token = Window.partitionBy("token")
    best = Window.partitionBy("b").orderBy(F.col("met").desc(), "a")
    star = shared.where("key <> centre").groupBy(F.col("centre").alias("a"), F.col("key").alias("b"))
    star = with_sizes(star.agg(F.sum("m").alias("met")))
    # A fifth of the prefix, about; less is left to the pairs.
    near = star.where(500 * F.col("met") >= (100 - join.share) * F.least("n_a", "n_b"))
    near = near.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= join.star_edges)
    families = _components(stored(near.select("a", "b"), "star"))
    found = corpus.compare_families(families)
    # All other candidates: pairs of different families, with how often they meet.
    rows = shared.select("token", "key", "m").join(families, "key", "left").withColumn("label", F.coalesce("label", "key"))
    several = F.min("label").over(by_token) != F.max("label").over(by_token)
    rows = rows.withColumn("_several", several).where("_several")
    # How many n-grams a set can meet others on at all bounds how often it meets any one of them.
    most = F.sum("m").over(Window.partitionBy("key"))
    mixed = stored(rows.join(n, "key").select("token", "key", "m", "label", "n", most.alias("most")), "mixed")
    left = mixed.select("token", F.col("m").alias("t_a"), F.col("key").alias("a"), F.col("label").alias("l_a"), F.col("n").alias("n_a"), F.col("most").alias("m_a"))
    right = mixed.select("token", F.col("m").alias("t_b"), F.col("key").alias("b"), F.col("label").alias("l_b"), F.col("n").alias("n_b"), F.col("most").alias("m_b"))
    # Past the prefix that ends first, the overlap is at most what is left of that set.
    rest = F.greatest(*[F.ceil(F.col(c) * join.share / 100) - 1 for c in ("n_a", "n_b")])
    needed = _needed(join, F.col("n_a"), F.col("n_b"))
    different = (F.col("a") < F.col("b")) & (F.col("l_a") != F.col("l_b")) & fit(F.col("n_a"), F.col("n_b"))
    open_ = (
        left.join(right, "token")
        .where(different & (F.least("m_a", "m_b") + rest >= needed))
        .groupBy("a", "b")
        .agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"), F.sum(F.least("t_a", "t_b")).alias("met"))
        .where(F.col("met") + rest >= needed)
    )
    pairs = corpus.compare(open_)
    labels = _components(found.where("b IS NOT NULL").select("a", "b").union(pairs))
    counts = pairs.select(F.explode(F.array("a", "b")).alias("key"), F.lit(1).cast("bigint").alias("n"))
    counts = counts.union(found.where("b IS NULL").select("a", "n"))
    degree = counts.groupBy("key").agg(F.sum("n").alias("n_links"))
    nodes = corpus.nodes.join(labels, "key", "left").join(degree, "key", "left")
    return nodes.select("id", "mark", "n", F.coalesce("label", "key").alias("group"), "n_links")


def link_documents(docs: DataFrame, join: Join = Join(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for every row, in no order.

    component_id is the smallest id that links reach, itself included. n_links is the number of different
    other sets that the document's set links with; equal sets are one and need no link. A text
    without words has an empty set and is linked with nothing. Rows without an id are linked like others
    and have the smallest id of their group, null if there is none. Repeated rows are kept. No text is
    too long, and sets are compared by 62-bit hashes of their n-grams.
    """
    rows = stored(_grouped(docs, join, doc_id, text), "grouped")
    ids = rows.where("group IS NOT NULL").groupBy("group").agg(F.min("id").alias("component"))
    # Blank texts have no group; each is on its own.
    return rows.join(ids, "group", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
    )


def keep_one(docs: DataFrame, join: Join = Join(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, with the columns that it had: the one with the smallest id, then the smallest
    hash of its text; of repeated rows of that one, the first by a hash of all columns. Texts without
    words are in no group and all stay. A group without ids keeps one of its rows too.
    """
    rows = _grouped(docs, join, doc_id, text).where("group IS NOT NULL")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("id"), "mark"))
    chosen = rows.groupBy("group").agg(first.alias("_first")).select("_first.no_id", "_first.id", "_first.mark")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    id_ = F.col(f"`{doc_id}`").cast("bigint")
    held = docs.select(
        F.struct(*columns).alias("__row"),
        id_.isNull().alias("no_id"),
        F.coalesce(id_, F.lit(0)).alias("id"),
        F.xxhash64(F.col(f"`{text}`")).alias("mark"),
        F.xxhash64(*columns).alias("__draw"),
        F.col(f"`{text}`").rlike(f"[^{SPACES}]").alias("__words"),
    )
    key = ["no_id", "id", "mark"]
    place = F.row_number().over(Window.partitionBy(*key).orderBy("__draw"))
    kept = held.where("__words").join(chosen, key, "left_semi").withColumn("__place", place).where("__place = 1")
    blank = held.where(~F.coalesce("__words", F.lit(False)))
    return kept.select("__row.*").unionByName(blank.select("__row.*"))

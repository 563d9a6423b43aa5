"""Passages that repeat across documents, by content-defined chunks.

A gear hash rolls over the bytes of a text: it depends on the last few bytes alone. A chunk ends where the hash
is the smallest within a reach to both sides. So a passage is cut alike wherever it stands, but for the
chunk at each of its ends, and an insertion moves no cut beyond its own surroundings; chunks are neither
tiny nor, in ordinary text, much longer than a few reaches. Where a text repeats itself within a reach no hash is
the smallest alone; there every few of the equal smallest ones cut, and the chunks between are alike too.
They are matched by a 96-bit digest. Runs of neighbouring chunks that other documents hold too are passages, if
they may be long enough: what a passage loses at its ends lies in the chunks around its run, so the words there
count as well, and no passage of the length asked for is lost by it.

Most chunks stand in one place only. Their hashes are counted first, eight bytes a chunk, and the repeated ones
are marked in a Bloom filter; only chunks that it lets through are moved, and compared by their digests.
Digests are counted with partial sums, so a chunk that is in most documents is a row per task, and the join
that follows is one that Spark splits where a digest is hot. No two documents are ever paired.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devicepulse.llm.common import sized, stored

BATCH_BYTES = 2 << 20
BITS = 32  # of a hash


@dataclass(frozen=True)
class Chunking:
    """Chunks of about twice `reach` bytes, by a hash of `window` bytes, a power of two up to 32; one is cut at
    `longest` bytes where no cut comes.

    A passage is reported if its repeated chunks, with what the cuts at its ends may have lost, hold at least
    `words` words in a row. In scripts without spaces, where a word takes more than `word_bytes` bytes on
    average, `size` bytes of repeated chunks do as well. The filter of repeated chunks has `filter_bits` bits, a
    power of two up to 2^32, whatever the table; an eighth as many bytes reach the driver and every task. With more
    than half as many repeated chunks as bits most others pass too, which costs disk and changes no result.
    """

    reach: int = 32
    longest: int = 1024
    words: int = 50
    seed: int = 29
    window: int = BITS
    size: int = 128
    word_bytes: int = 24
    filter_bits: int = 1 << 27

    def __post_init__(self):
        if self.longest >= 1 << 14:
            raise ValueError("numbers of a chunk are packed in 16 bits each")


# What short words need: with 51 words of two letters there are still several whole chunks in a passage.
FINE = Chunking(reach=16, window=8)


def _gears(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 32, 256, dtype=np.uint32)


def rolling(data: np.ndarray, gears: np.ndarray, window: int = BITS) -> np.ndarray:
    """The gear hash at every byte: each byte's number, shifted by its distance, summed over the last `window`.

    Sums over 1, 2, 4 … bytes are put together, so there are few steps over the whole array."""
    h = gears[data]
    span, shift = 1, BITS // window
    while span < window:
        h[span:] = h[span:] + (h[:-span] << np.uint32(span * shift))
        span *= 2
    return h


def _least(h: np.ndarray, n: int) -> np.ndarray:
    """The smallest of the n numbers that begin at each place; beyond the end there are none."""
    out, span = h.copy(), 1
    while span < n:
        step = min(span, n - span)
        out[:-step] = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:-step]
        span += step
    return out


def _apart(found: np.ndarray, equal: np.ndarray, least: int) -> list[int]:
    """Of the equal places, those that come at least so far after the last place found or taken.

    Within a period all steps are alike, so they cut the same bytes wherever the repetition begins."""
    taken, last, i = [], 0, 0
    while i < len(equal):
        k = int(np.searchsorted(found, equal[i]))
        last = max(last, int(found[k - 1]) if k else 0)
        if equal[i] - last >= least:
            last = int(equal[i])
            taken.append(last)
        i = int(np.searchsorted(equal, last + least))
    return taken


def cuts(data: np.ndarray, chunking: Chunking) -> np.ndarray:
    """Where chunks end, the end of the data included; never within a character."""
    size, reach = len(data), chunking.reach
    if not size:
        return np.empty(0, np.int64)
    h = rolling(data, _gears(chunking.seed), chunking.window)
    padded = np.concatenate([np.full(reach, 0xFFFFFFFF, np.uint32), h, np.full(reach, 0xFFFFFFFF, np.uint32)])
    least = _least(padded, reach)
    # Smaller than all before it in reach, and no larger than any after.
    before, after = least[:size], least[reach + 1 : reach + 1 + size]
    found = np.flatnonzero((h < before) & (h <= after)) + 1
    # As small as the smallest in reach: one in each period of what repeats within a reach.
    equal = np.flatnonzero((h == before) & (h <= after)) + 1
    ends = np.unique(np.concatenate([found, np.array(_apart(found, equal, 2 * reach), np.int64), [size]]))
    begins = np.concatenate([[0], ends[:-1]])
    long = np.flatnonzero(ends - begins > chunking.longest)
    extra = [np.arange(begins[i] + chunking.longest, ends[i], chunking.longest) for i in long]
    ends = np.concatenate([ends, *extra])
    characters = np.append(np.flatnonzero(data & 0xC0 != 0x80), size)
    return np.unique(characters[np.searchsorted(characters, ends)])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _words_before(data: np.ndarray) -> np.ndarray:
    """How many words begin before each place, the end of the data included."""
    space = _SPACE[data]
    begins = ~space & np.concatenate([[True], space[:-1]])
    return np.concatenate([[0], np.cumsum(begins)])


def words_of_chunks(data: np.ndarray, ends: np.ndarray, chunking: Chunking) -> np.ndarray:
    """Three rows: how many words begin in each chunk, and how many of a passage may begin before and after it
    if the passage's first or last whole chunk is this one.

    A cut is alike in all copies if `window` and `reach` bytes before it and `reach` bytes after it belong to
    the passage. So a passage begins less than that before the chunk in front of its first whole one, and
    ends less than that after the chunk behind its last one; 3 bytes more, as cuts move to the next character.
    """
    counts, begins = _words_before(data), np.concatenate([[0], ends[:-1]])
    front = np.concatenate([[0], begins[:-1]])
    behind = np.concatenate([ends[1:], ends[-1:]])
    before = counts[begins] - counts[np.maximum(front - chunking.reach - chunking.window - 3, 0)]
    after = counts[np.minimum(behind + chunking.reach + 3, len(data))] - counts[ends]
    return np.stack([counts[ends] - counts[begins], before, after])


# What a chunk has, each less than 2^15.
_SIZES = ("size", "n_words", "before", "after")


def chunks(df: DataFrame, chunking: Chunking, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, mark, digest, place, begin, size, n_words, before, after): the chunks of every text, in bytes, place
    from 0, with the words of `words_of_chunks`.

    `doc` is the id, or the text's hash where it is null; `mark` is that hash. Blank texts have no chunks.
    """
    mark = F.xxhash64(F.col(f"`{text}`"))
    slim = df.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), mark).alias("doc"), mark.alias("mark"), F.col(f"`{text}`").alias("t")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized(batches, 2, BATCH_BYTES):
            rows, digests, parts = [], [], [np.empty((6, 0), np.int64)]
            for i, text in enumerate(batch.column(2).to_pylist()):
                if not text:
                    continue
                raw = text.encode()
                data = np.frombuffer(raw, np.uint8)
                ends = cuts(data, chunking)
                begins = np.concatenate([[0], ends[:-1]])
                spans = zip(begins.tolist(), ends.tolist(), strict=True)
                digests += [blake2b(raw[a:b], digest_size=12).digest() for a, b in spans]
                rows += [i] * len(ends)
                words = words_of_chunks(data, ends, chunking)
                parts.append(np.stack([np.arange(len(ends)), begins, ends - begins, *words]))
            take, numbers = pa.array(rows, pa.int32()), np.concatenate(parts, 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    pa.array(digests, pa.binary()),
                    *[pa.array(row.astype(np.int32)) for row in numbers],
                ],
                ["doc", "mark", "digest", "place", "begin", *_SIZES],
            )

    return slim.mapInArrow(
        run,
        "doc bigint, mark bigint, digest binary, place int, begin int, " + ", ".join(f"{c} int" for c in _SIZES),
    )


PROBES = 3  # bits that stand for a hash in the filter


def _marks(h: Column, bits: int) -> list[Column]:
    """The bits of a hash: its lower half, and that plus multiples of its upper half."""
    low, high = h.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return [(low + high * i).bitwiseAND(F.lit(bits - 1)) for i in range(PROBES)]


def _marked(hashes: np.ndarray, words: np.ndarray, bits: int) -> np.ndarray:
    """Whether all bits of each hash are set."""
    h = hashes.view(np.uint64)
    low, high, found = h & np.uint64((1 << 32) - 1), h >> np.uint64(32) | np.uint64(1), np.ones(len(h), bool)
    for i in range(PROBES):
        at = low + high * np.uint64(i) & np.uint64(bits - 1)
        found &= (words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def _repeated_only(rows: DataFrame, bits: int) -> DataFrame:
    """The rows whose digest stands in several rows, and a few others; all others are left out."""
    h = F.xxhash64("digest")
    repeated = rows.groupBy(h.alias("h")).agg(F.count("*").alias("n")).where("n > 1")
    bit = repeated.select(F.explode(F.array(*_marks(F.col("h"), bits))).alias("bit"))
    mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit").bitwiseAND(F.lit(63)).cast("int"))
    # At most a row for each 64 bits of the filter.
    found = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(mark).alias("mark")).toArrow()
    words = np.zeros(-(-bits // 64), np.uint64)
    words[found.column("word").to_numpy()] = found.column("mark").to_numpy().view(np.uint64)
    shared = rows.sparkSession.sparkContext.broadcast(words.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(shared.value, np.uint64)
        for batch in batches:
            passed = pa.array(_marked(batch.column("_h").to_numpy(), known, bits))
            yield batch.drop_columns(["_h"]).filter(passed)

    return rows.withColumn("_h", h).mapInArrow(run, rows.schema)


def _passages(df: DataFrame, chunking: Chunking, doc_id: str, text: str) -> DataFrame:
    made = stored(chunks(df, chunking, doc_id, text), "chunks")
    # Six numbers in two columns, as the shuffle of these chunks takes disk.
    big = lambda c: F.col(c).cast("bigint")
    has = big(_SIZES[0])
    for c in _SIZES[1:]:
        has = F.shiftleft(has, 16).bitwiseOR(big(c))
    at = F.shiftleft(big("place"), 32).bitwiseOR(big("begin"))
    slim = made.select("digest", "doc", "mark", at.alias("_at"), has.alias("_has"))
    slim = stored(_repeated_only(slim, chunking.filter_bits), "candidates")
    seen = slim.groupBy("digest").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("_last"))
    part = lambda c, shift, bits: F.shiftright(c, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    again = slim.join(seen.where("first_doc <> _last").drop("_last"), "digest").select(
        "doc",
        "mark",
        "first_doc",
        part("_at", 32, 31).alias("place"),
        part("_at", 0, 32).alias("begin"),
        *[part("_has", 48 - 16 * i, 16).alias(c) for i, c in enumerate(_SIZES)],
    )
    # Repeated rows have every place several times; a run goes on where the place does. A passage is a run of
    # repeated chunks; its parts are the runs within it that are first here, and those that are not.
    in_text, of_kind = Window.partitionBy("doc", "mark"), Window.partitionBy("doc", "mark", "first")
    place = F.col("place")
    runs = (
        again.withColumn("first", F.col("doc") == F.col("first_doc"))
        .withColumn("_run", place - F.dense_rank().over(in_text.orderBy("place")))
        .withColumn("_part", place - F.dense_rank().over(of_kind.orderBy("place")))
    )
    parts = (
        runs.dropDuplicates(["doc", "mark", "place"])
        .groupBy("doc", "mark", "_run", "first", "_part")
        .agg(
            F.min("begin").alias("begin"),
            F.max(F.col("begin") + F.col("size")).alias("end"),
            F.sum("n_words").alias("n_words"),
            F.sum("size").alias("_size"),
            F.min("first_doc").alias("first_doc"),
            F.min_by("before", "place").alias("_before"),
            F.max_by("after", "place").alias("_after"),
        )
    )
    whole = Window.partitionBy("doc", "mark", "_run")
    # What is first here in a few words alone is kept, and no row of its own.
    held = lambda name: F.when(F.col("first"), F.col(name)).otherwise(F.sum(name).over(whole))
    edge = lambda by, name: F.when(F.col("first"), F.col(name)).otherwise(by(name, "begin").over(whole))
    around = edge(F.min_by, "_before") + edge(F.max_by, "_after")
    wide = (held("_size") >= chunking.size) & (held("_size") > chunking.word_bytes * held("n_words"))
    return parts.withColumn("_enough", (held("n_words") + around >= chunking.words) | wide).where("_enough")


def repeated_passages(
    df: DataFrame, chunking: Chunking = FINE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, begin, end, n_words, is_first, first_doc): the passages of each document that other
    documents hold too, in bytes of the UTF-8 text. Documents without one have no row. begin, end and n_words are
    those of the repeated chunks, so they are some 40 bytes short of the passage at each end.

    is_first says that this document has the smallest id of all that hold it, so a passage is kept once;
    first_doc is that id (the smallest, where chunks differ). A passage that is first here in parts alone has a
    row for each part; those that are not first are rows, and cut, if all parts together have enough. Rows with the same id and text are one
    document. A null id is counted as a document of its own by its text, and is null here. Passages within
    one document alone are none.
    """
    found = _passages(df, chunking, doc_id, text)
    return found.select(
        F.when(F.col("doc") != F.col("mark"), F.col("doc")).alias("doc_id"),
        "begin",
        "end",
        "n_words",
        F.col("first").alias("is_first"),
        F.when(F.col("first_doc") != F.col("mark"), F.col("first_doc")).alias("first_doc"),
    )


def without_repeats(
    df: DataFrame, chunking: Chunking = FINE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The same rows and columns, with each passage cut out of all documents but its first."""
    found = _passages(df, chunking, doc_id, text).where(~F.col("first"))
    spans = found.groupBy("doc", "mark").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("__spans"))
    mark = F.xxhash64(F.col(f"`{text}`"))
    held = df.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), mark).alias("doc"),
        mark.alias("mark"),
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"),
    ).join(spans, ["doc", "mark"], "left")
    raw = F.encode(F.col(f"__row.`{text}`"), "utf-8")
    # What lies between the spans: from the end of one to the begin of the next.
    ends = F.concat(F.array(F.lit(0)), F.col("__spans.end"))
    begins = F.concat(F.col("__spans.begin"), F.array(F.octet_length(raw)))
    kept = F.transform(F.arrays_zip(ends.alias("a"), begins.alias("b")), lambda s: F.substr(raw, s["a"] + 1, s["b"] - s["a"]))
    cut = F.decode(F.aggregate(kept, F.lit(b""), lambda out, part: F.concat(out, part)), "utf-8")
    made = F.when(F.col("__spans").isNull(), F.col(f"__row.`{text}`")).otherwise(cut)
    return held.select(*[(made if c == text else F.col(f"__row.`{c}`")).alias(c) for c in df.columns])

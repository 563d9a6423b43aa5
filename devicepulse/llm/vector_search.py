"""Exact top-k search by inner product, in buckets of vectors of like length.

Vectors are laid out in ranges of falling length and go through a task in buckets of a bounded number, so
a bucket knows its longest vector. For a query, the score that its k-th best so far has gives
each bucket a cosine that a vector in it must reach: none can where that is over 1, only the longer
ones where it is near, and otherwise a few large coordinates of the query bound what the others can still
add. Products are computed only for what is left.

Queries come in blocks of a bounded number. Every block goes over all vectors, each task returns its
k best per query, and the best of those are the answer.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devicepulse.sources.workspace import scratch_path

BUCKET = 2048  # vectors
QUERY_BLOCK = 4096  # queries
FOCUS = 8  # coordinates of a query that are looked at first
EXACT = 1 << 53  # whole numbers up to this are exact as doubles


def whole_numbers(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as bigint; null where the vector or a component is null or not
    finite."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))), F.lit(False)),
    )
    numbers = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return F.when(finite, numbers)


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows padded with zeros to `width`."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number inner products, exact: by doubles where they fit, else in whole numbers, whose sums are
    right modulo 2^64 and so wherever the result fits."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    near = a.astype(float) @ b.T.astype(float)
    if most < EXACT:
        return near.astype(np.int64)
    if np.abs(near).max(initial=0) > float(1 << 63) - float(1 << 16) - most * 1e-13:
        raise OverflowError("a score does not fit in 64 bits")
    return a @ b.T


class _Best:
    """The k best (score, vec_id) of each query so far; ties go to the smaller id."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.found = np.zeros((n, k), bool)
        self.floor = floor

    def bar(self) -> np.ndarray:
        """What a score must reach to matter, per query."""
        return np.where(self.found[:, -1], np.maximum(self.score[:, -1], self.floor), self.floor)

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        score = np.concatenate([self.score[q][self.found[q]], scores])
        id_ = np.concatenate([self.id[q][self.found[q]], ids])
        best = np.lexsort((id_, -score))[: self.score.shape[1]]
        n = len(best)
        self.score[q, :n], self.id[q, :n], self.found[q, :n] = score[best], id_[best], True


def _search_bucket(best: _Best, query_ids, queries, q_norms, ids, vectors, norms) -> None:
    """Look for better answers among the vectors of one bucket, longest first."""
    bar = best.bar().astype(float)
    longest = float(norms[0]) if len(norms) else 0.0
    # Doubles of norms are rounded; a little slack keeps the bounds on the safe side.
    reach = q_norms * longest * (1 + 1e-9) + 1e-6
    active = np.flatnonzero(reach >= bar)
    if not len(active) or not len(ids):
        return
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(reach[active] > 0, bar[active] / reach[active], -1.0)
    # A high local threshold leaves only the longest vectors: cut the bucket by length. A middling one is
    # served by the large coordinates. Below that every vector is a candidate.
    by_length, by_focus = cosine > 0.95, (cosine > 0.3) & (cosine <= 0.95) & (queries.shape[1] > FOCUS)
    every = ~by_length & ~by_focus
    if every.any():
        rows = active[every]
        for at in range(0, len(rows), 256):
            part = rows[at : at + 256]
            _verify(best, part, _products(queries[part], vectors), query_ids, ids)
    for q in active[by_length]:
        n = int(np.searchsorted(-norms, -(bar[q] - 1e-6) / (q_norms[q] * (1 + 1e-9)), side="right"))
        if n:
            _verify(best, [q], _products(queries[q : q + 1], vectors[:n]), query_ids, ids[:n])
    for q in active[by_focus]:
        focus = np.argpartition(-np.abs(queries[q]), FOCUS)[:FOCUS]
        part = vectors[:, focus].astype(float)
        known = part @ queries[q, focus].astype(float)
        rest_q = np.sqrt(max(q_norms[q] ** 2 - float((queries[q, focus].astype(float) ** 2).sum()), 0))
        rest = np.sqrt(np.maximum(norms**2 - (part**2).sum(1), 0))
        some = np.flatnonzero(known + rest_q * rest + 1e-9 * reach[q] + 1e-6 >= bar[q])
        if len(some):
            _verify(best, [q], _products(queries[q : q + 1], vectors[some]), query_ids, ids[some])


def _verify(best: _Best, rows, scores, query_ids, ids) -> None:
    bar = best.bar()
    for q, row in zip(rows, scores, strict=True):
        good = np.flatnonzero((row >= bar[q]) & (ids != query_ids[q]))
        k = best.score.shape[1]
        if len(good) > 4 * k:
            # The k-th largest score, and all that tie with it.
            least = np.partition(row[good], -k)[-k]
            good = good[row[good] >= least]
        if len(good):
            best.add(q, row[good], ids[good])


def _top_of_block(vectors: DataFrame, block, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each task for each query of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, floor = pickle.loads(block.value)
        q_norms = np.sqrt((queries.astype(float) ** 2).sum(1))
        best = _Best(len(query_ids), k, floor)
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                part = batch.slice(at, BUCKET)
                ids = part.column(0).to_numpy()
                width = max(queries.shape[1], int(pc.max(part.column(1).value_lengths()).as_py() or 0))
                rows = _matrix(part.column(1), width)
                wide = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
                norms = np.sqrt((rows.astype(float) ** 2).sum(1))
                order = np.argsort(-norms, kind="stable")
                _search_bucket(best, query_ids, wide, q_norms, ids[order], rows[order], norms[order])
        q, place = np.nonzero(best.found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids[q]), pa.array(best.id[q, place]), pa.array(best.score[q, place])],
            ["query_id", "vec_id", "score"],
        )

    return vectors.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def _blocks(queries: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Queries in blocks of at most QUERY_BLOCK, each small enough for the driver, one at a time."""
    n = queries.count()
    blocks = -(-n // QUERY_BLOCK) * 2
    # Twice as many hash blocks as are needed full, and any over the size is cut, so a block is bounded.
    for i in range(blocks):
        held = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i)
        pending: list = []
        for row in held.toLocalIterator(prefetchPartitions=False):
            pending.append((row.id, row.numbers))
            if len(pending) == QUERY_BLOCK:
                yield _as_block(pending)
                pending = []
        if pending:
            yield _as_block(pending)


def _as_block(rows: list) -> tuple[np.ndarray, np.ndarray]:
    lists = pa.array([r[1] for r in rows], pa.list_(pa.int64()))
    width = max((len(r[1]) for r in rows), default=0)
    return np.array([r[0] for r in rows], np.int64), _matrix(lists, width)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = 1024,
) -> DataFrame:
    """The k best other rows of `vectors` for each row of `queries`: (query_id, rank, vec_id, score).

    The score is the inner product of floor(scale * x), a whole number; ties go to the smaller id. Rows
    with a null id, a null vector or a component that is null or not finite take no part. Shorter vectors
    count as padded with zeros. A query's own id is no answer, whatever rows carry it; other repeated
    ids are answers one by one. Fewer than k candidates give them all. An id that occurs in several
    query rows is asked once, by its largest numbers. Scores beyond 64 bits raise.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        made = df.select(
            F.col(f"`{vec_id}`").cast("bigint").alias("id"), whole_numbers(F.col(f"`{vector}`"), scale).alias("numbers")
        )
        return made.where("id IS NOT NULL AND numbers IS NOT NULL")

    norm = F.aggregate("numbers", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    rows = clean(vectors).withColumn("norm", norm)
    path = scratch_path(spark, "vectors")
    # Equal lengths are told apart by the id, so no range grows with them.
    rows.repartitionByRange(F.col("norm").desc(), F.xxhash64("id")).sortWithinPartitions(
        F.col("norm").desc()
    ).write.parquet(path)
    laid = spark.read.parquet(path).select("id", "numbers")
    asked = clean(queries).groupBy("id").agg(F.max("numbers").alias("numbers"))
    # Any k vectors bound a query's k-th best from below; the longest ones are the likeliest to be good.
    longest = spark.read.parquet(path).orderBy(F.col("norm").desc(), "id").limit(BUCKET).select("id", "numbers").collect()
    first_ids, first = _as_block([(r.id, r.numbers) for r in longest])
    out = scratch_path(spark, "answers")
    by_query = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    spark.createDataFrame([], schema).write.parquet(out)
    for ids, numbers in _blocks(asked):
        width = max(numbers.shape[1], first.shape[1])
        wide = np.pad(numbers, ((0, 0), (0, width - numbers.shape[1])))
        seed = _Best(len(ids), k, np.full(len(ids), np.iinfo(np.int64).min))
        _verify(seed, range(len(ids)), _products(wide, np.pad(first, ((0, 0), (0, width - first.shape[1])))), ids, first_ids)
        floor = np.where(seed.found[:, -1], seed.score[:, -1], np.iinfo(np.int64).min)
        block = spark.sparkContext.broadcast(pickle.dumps((ids, numbers, floor)))
        ranked = _top_of_block(laid, block, k).withColumn("rank", F.row_number().over(by_query))
        ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(out)
        block.destroy()
    return spark.read.schema(schema).parquet(out)

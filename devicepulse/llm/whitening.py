"""Whitening of vectors of whole numbers by a bidiagonal qd solver.

Tasks reduce their centred rows to a triangular factor by QR, block after block, and factors are joined the
same way in rounds, so nothing larger than a few factors meets in one place. The last factor R has the
covariance of the rows, divided by their number, as R'R. On the driver, Householder reflections make R
bidiagonal, dqds finds the squares of its singular values without forming R'R, and a twisted factorisation of
each shifted B'B, B being the bidiagonal, gives the direction and corrects the value.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicepulse.llm.common import slices, stored
from devicepulse.llm.vector_search import whole_numbers

COMPONENTS = 16
BLOCK = 4096  # rows that are reduced at a time
FAN_IN = 32  # triangular factors that are joined in one task
EPS = float(np.finfo(float).eps)


# The solver --------------------------------------------------------------------------------------------


def reduced(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
    """The triangular factor of all rows of the blocks; None where there are none."""
    r = None
    for block in blocks:
        if len(block):
            r = np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")
    return r


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """The unit vector of the reflection that takes x to its first axis."""
    size = np.abs(x).max(initial=0.0)
    if size == 0 or not np.abs(x[1:]).any():
        return None
    v = x / size
    v[0] += np.copysign(np.sqrt(v @ v), v[0])
    return v / np.sqrt(v @ v)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and upper diagonal of B, and P, in R = Q B P'."""
    a = np.array(r, float)
    d = a.shape[1]
    a = np.vstack([a, np.zeros((d - len(a), d))]) if len(a) < d else a
    p = np.eye(d)
    for k in range(d):
        v = _reflector(a[k:, k].copy())
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v = _reflector(a[k, k + 1 :].copy())
            if v is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
                p[:, k + 1 :] -= 2 * np.outer(p[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), p


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds transform; None where the shift is more than the smallest value."""
    new_q, new_e, d = [], [], q[0] - shift
    for i, down in enumerate(e):
        if d < 0:
            return None
        top = d + down
        new_q.append(top)
        if top == 0:
            new_e.append(0.0)
            d = q[i + 1] - shift
            continue
        ratio = q[i + 1] / top
        new_e.append(down * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    return [*new_q, d], new_e


def _smaller(q: list[float], e: list[float]) -> float:
    """The smaller square of a singular value of the last two rows."""
    a, c, b = q[-2], q[-1], e[-1]
    half = (a + b + c) / 2
    root = np.sqrt(max(half * half - a * c, 0.0))
    return a * c / (half + root) if half + root > 0 else 0.0


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """The squares of the singular values of a bidiagonal matrix, falling, by dqds."""
    found: list[float] = []
    parts = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in upper], 0.0)]
    while parts:
        q, e, shifted = parts.pop()
        if q and q[0] < q[-1]:
            q, e = q[::-1], e[::-1]
        trust = 1.0
        while q:
            most = max(q) + shifted
            small = [i for i, x in enumerate(e) if x <= EPS * EPS * most or x <= EPS * EPS * q[i + 1]]
            if len(q) == 1 or (small and small[-1] == len(e) - 1):
                found.append(q.pop() + shifted)
                e = e[: len(q) - 1] if q else []
                trust = 1.0
                continue
            if small:
                cut = small[-1]
                parts.append((q[: cut + 1], e[:cut], shifted))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            # The smaller value of the last rows is an upper bound that gets sharp; too much is tried again.
            shift = trust * _smaller(q, e)
            made = _sweep(q, e, shift)
            while made is None:
                trust, shift = trust / 2, (shift / 4 if trust > 1e-3 else 0.0)
                made = _sweep(q, e, shift)
            else:
                trust = min(1.0, trust * 1.5)
            q, e = made
            shifted += shift
    return np.sort(np.array(found))[::-1]


def _twisted(diagonal: np.ndarray, upper: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """A vector z and the correction of the value, from the factorisation of B'B - value that is twisted where
    its pivot is smallest."""
    n, tiny = len(diagonal), EPS * EPS * max(value, np.finfo(float).tiny)
    down, up = np.zeros(n), np.zeros(n)  # multipliers of the two factorisations
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + diagonal[i] ** 2
        pivot = pivot if abs(pivot) > tiny else -tiny
        down[i] = diagonal[i] * upper[i] / pivot
        s[i + 1] = upper[i] ** 2 * (s[i] / pivot) - value
    p[n - 1] = diagonal[n - 1] ** 2 - value
    for i in range(n - 2, -1, -1):
        pivot = upper[i] ** 2 + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else -tiny
        up[i] = diagonal[i] * upper[i] / pivot
        p[i] = p[i + 1] * (diagonal[i] ** 2 / pivot) - value
    gamma = s + p + value
    r = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -up[i] * z[i]
    size = float(z @ z)
    return z / np.sqrt(size), float(gamma[r]) / size


def _close_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Directions of values that are too close to be told apart: an orthonormal basis of the invariant space,
    by inverse iteration on all of them together."""
    n = len(diagonal)
    square = np.diag(diagonal**2) + np.diag(diagonal[:-1] * upper, 1) + np.diag(diagonal[:-1] * upper, -1)
    square[np.arange(1, n), np.arange(1, n)] += upper**2
    # A little beside the values: what solving loses to rounding lies in the space that is looked for.
    shifted = square - values.mean() * (1 + 1e-12) * np.eye(n)
    basis = np.linalg.qr(np.random.default_rng(0).normal(size=(n, len(values))))[0]
    for _ in range(4):
        basis = np.linalg.qr(np.linalg.solve(shifted, basis))[0]
    return basis


def principal(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of R'R, falling, at most `most` and only those above rounding, and their unit
    vectors as columns."""
    d = r.shape[1]
    diagonal, upper, p = bidiagonal(r)
    size = max(np.abs(diagonal).max(initial=0.0), np.abs(upper).max(initial=0.0))
    if size == 0:
        return np.zeros(0), np.zeros((d, 0))
    diagonal, upper = diagonal / size, upper / size
    values = squared_singular_values(diagonal, upper)
    k = int((values[:most] > (16 * d * EPS) ** 2 * values[0]).sum())
    vectors, at = np.zeros((d, k)), 0
    while at < k:
        end = at + 1
        while end < len(values) and values[end - 1] - values[end] <= 1e-9 * values[end - 1]:
            end += 1
        if end - at > 1:
            made = _close_vectors(diagonal, upper, values[at:end])
            vectors[:, at : min(end, k)] = made[:, : min(end, k) - at]
        else:
            value = values[at]
            for _ in range(3):
                vectors[:, at], more = _twisted(diagonal, upper, value)
                value += more
            values[at] = value
        at = end
    vectors = p @ vectors
    # Two passes of Gram-Schmidt take off what is left of rounding between neighbours.
    vectors = np.linalg.qr(vectors)[0] if k else vectors
    return values[:k] * size**2, vectors


# Tables ------------------------------------------------------------------------------------------------


def steps(vector: Column, scale: int = 64, offset: int = 1_000_000) -> Column:
    """floor(scale * c) + offset of each entry as bigint; null where the vector or an entry is null or not
    finite, or where there is no entry."""
    made = F.transform(whole_numbers(vector, scale), lambda x: x + F.lit(offset).cast("bigint"))
    return F.when(F.size(vector) > 0, made)


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: `n` distinct vectors, their sums by entry, one row of `directions` a component."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    directions: np.ndarray
    explained: np.ndarray
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions.T / np.sqrt(self.values)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) / n


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    if len(lists) and (lists.value_lengths().to_numpy() != width).any():
        raise ValueError(f"vectors must all have {width} entries")
    return lists.flatten().to_numpy().reshape(-1, width)


def _factors(df: DataFrame, read) -> np.ndarray | None:
    """The triangular factor of all rows, `read` giving those of a batch as a matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = reduced(read(b) for b in slices(batches, BLOCK))
        if r is not None:
            rows = [pa.array([len(r)]), pa.array([r.ravel().tolist()], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(rows, ["n_rows", "factor"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.array(f).reshape(m, -1) for b in batches for m, f in zip(*b.to_pydict().values(), strict=True))
        r = reduced(held)
        if r is not None:
            rows = [pa.array([len(r)]), pa.array([r.ravel().tolist()], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(rows, ["n_rows", "factor"])

    schema = "n_rows bigint, factor array<double>"
    factors = stored(df.mapInArrow(run, schema), "factors")
    left = factors.count()
    while left > FAN_IN:
        parts = -(-left // FAN_IN)
        factors = stored(factors.repartition(parts).mapInArrow(again, schema), "factors")
        left = factors.count()
    return reduced(np.array(row.factor).reshape(row.n_rows, -1) for row in factors.collect())


def _identity_error(fit_rows: DataFrame, model: Whitening) -> float:
    """The largest entry of the covariance of the whitened vectors minus the identity."""
    k, width = len(model.values), len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in slices(batches, BLOCK):
            made = model.whitened(_matrix(batch.column(0), width))
            total += made.sum(0)
            products += made.T @ made
        # Row k has the sums.
        i, j = np.meshgrid(np.arange(k + 1), np.arange(k), indexing="ij")
        values = np.vstack([products, total])
        yield pa.RecordBatch.from_arrays([pa.array(x.ravel()) for x in (i, j, values)], ["i", "j", "x"])

    sums = fit_rows.select("x").mapInArrow(run, "i bigint, j bigint, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    held = np.zeros((k + 1, k))
    for row in sums.collect():
        held[row.i, row.j] = row.x
    mean = held[k] / model.n
    # The vectors are centred already, so what the means take off is rounding.
    return float(np.abs(held[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def fit(df: DataFrame, vector: str = "embedding", most: int = COMPONENTS) -> Whitening:
    """Fit on the distinct vectors of `steps`, each once, however many rows have it.

    Rows whose vector is null or empty or has an entry that is null or not finite are left out. Directions
    along which the vectors do not differ are no components, so there may be fewer than `most`; no rows or
    equal rows give none. Vectors of unlike lengths raise.
    """
    rows = df.select(steps(F.col(f"`{vector}`")).alias("x")).where("x IS NOT NULL").distinct()
    rows = stored(rows, "fit_list")
    by_entry = rows.select(F.posexplode("x").alias("at", "x")).groupBy("at")
    sums = by_entry.agg(F.sum("x").alias("total"), F.count("*").alias("n")).orderBy("at").collect()
    if len({row.n for row in sums}) > 1:
        raise ValueError("vectors must all have as many entries")
    n = sums[0].n if sums else 0
    totals, width = np.array([row.total for row in sums], np.int64), len(sums)
    none = np.zeros(0)
    if n == 0:
        return Whitening(0, totals, none, np.zeros((0, 0)), none, 0.0)
    r = _factors(rows.select("x"), lambda b: centred(_matrix(b.column(0), width), n, totals))
    values, vectors = principal(r, most)
    trace = float((r * r).sum()) / n
    values = values / n
    model = Whitening(n, totals, values, vectors.T.copy(), values / trace if trace else none, 0.0)
    return Whitening(n, totals, values, model.directions, model.explained, _identity_error(rows, model))


def transform(df: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """Replace the vector by `whitened`, one number per component, and add `deviation`, the exact sum of
    (n * x - S)^2 over its entries. Rows that `fit` would leave out are dropped; other columns are
    kept, but for those named like the made ones. Rows with equal vectors get equal numbers."""
    made = [T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    names = [f.name for f in made]
    keep = [c for c in df.columns if c not in (*names, vector)]
    given = df.select(steps(F.col(f"`{vector}`")).alias("x"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("given"))
    given = given.where("x IS NOT NULL")
    schema = T.StructType([given.schema["given"], *made])
    width, k = len(model.sums), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BLOCK):
            x = _matrix(batch.column(0), width)
            away = model.n * x - model.sums
            if ((away.astype(float) ** 2).sum(1) > 9.2e18).any():
                raise OverflowError("a deviation does not fit in 64 bits")
            white = model.whitened(x)
            ends = pa.array(np.arange(len(x) + 1) * k, pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array((away**2).sum(1)), lists], schema.names)

    out = given.mapInArrow(run, schema)
    return out.select(*[F.col(f"given.`{c}`") for c in keep], *names)

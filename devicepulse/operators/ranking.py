"""Order-dependent operators over a whole table, without a one-partition window."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, floor, inf, nan, nextafter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from devicepulse.sources.workspace import pin


def running_total(
    df: DataFrame, order: Sequence[str], value: Column, name: str, within: Sequence[str] = ()
) -> DataFrame:
    """Running sum of `value` in key order over the whole table, restarting per `within`.

    `(within, order)` must be unique, so that ranges of it are of even size. The rows are laid
    out in ranges and stored with their range number, each range is summed on its own, and the
    sums of the ranges before it are added. Only the table of range sums (a row per range and
    `within` value in it) is broadcast; it is bounded by the number of ranges plus the number of
    `within` values, whatever the rows.
    """
    keys = [*within, *order]
    placed = pin(
        df.withColumn("_value", value.cast("bigint"))
        .repartitionByRange(*keys)
        .withColumn("_range", F.spark_partition_id())
    )
    sums = placed.groupBy(*within, "_range").agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *within, "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_range", *within).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        placed.withColumn("_inside", F.sum("_value").over(inside))
        .join(F.broadcast(offsets), ["_range", *within])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .select(*df.columns, name)
    )


def dense_number(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number the rows 1, 2, 3 … in key order. The key must be unique."""
    return running_total(df, order, F.lit(1), name)


def carry_forward(df: DataFrame, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The last known value of each column, in key order over the whole table. Rows before the first known one
    stay null.

    `order` must be unique, else which of two equal rows comes first is undefined. The rows are laid out
    in ranges and stored with their range number; the last known values of each range are carried over the
    ranges after it until the next known one. That table has one row per range, and is all that is broadcast
    or meets in one task; a range without a known value of a column, or many of them, is passed over.
    """
    placed = pin(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    place = F.struct(*[F.col(f"`{c}`") for c in order])
    known = [F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), place)).alias(f"_{i}") for i, c in enumerate(columns)]
    last = placed.groupBy("_range").agg(*known)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.last(f"_{i}", ignorenulls=True).over(earlier).alias(f"_{i}") for i in range(len(columns))]
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = placed.join(F.broadcast(last.select("_range", *carried)), "_range")
    filled = {
        c: F.coalesce(F.last(F.col(f"`{c}`"), ignorenulls=True).over(inside), F.col(f"_{i}"))
        for i, c in enumerate(columns)
    }
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(f"`{c}`") for c in df.columns])


# How exact quantiles are narrowed down: points of a sketch per range, their accuracy, and the number of values
# of a range that are looked at one by one.
SKETCH_POINTS = 400
SKETCH_ACCURACY = 2000
FEW_VALUES = 4000


@dataclass
class _Range:
    """Values of a column from `low` to `high`, both included: `n` of them, and `before` smaller ones."""

    at: int
    low: float
    high: float
    before: int
    n: int
    ranks: set[int]

    def cut(self, points: Sequence[float]) -> list[_Range]:
        """The parts of the range between and at those of the points that lie around the wanted ranks; how many
        values each has is still to be counted."""
        edges: set[float] = set()
        for rank in self.ranks:
            # The points around the wanted rank, and one more on each side as the sketch is not exact.
            place = (rank - self.before) * (len(points) - 1) // self.n
            edges.update(x for x in points[max(0, place - 1) : place + 3] if self.low <= x <= self.high)
        parts, low = [], self.low
        for edge in sorted(edges):
            if low < edge:
                parts.append(_Range(self.at, low, nextafter(edge, -inf), 0, 0, set()))
            parts.append(_Range(self.at, edge, edge, 0, 0, set()))
            low = nextafter(edge, inf)
            if edge == inf:
                return parts
        if low <= self.high:
            parts.append(_Range(self.at, low, self.high, 0, 0, set()))
        return parts


def _literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A few rows as one literal, which costs no Python worker and little planning."""
    names = [f.split(" ")[0] for f in schema.split(", ")]
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    kind = schema.replace(" ", ":").replace(",:", ",")
    return spark.range(1).coalesce(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{kind}>>")))


def _in_ranges(cells: DataFrame, ranges: Sequence[_Range]) -> DataFrame:
    """Cells with the number of the range that holds them. The ranges, a few for each column and
    probability, are broadcast."""
    rows = [(i, r.at, float(r.low), float(r.high)) for i, r in enumerate(ranges)]
    table = _literal_rows(cells.sparkSession, rows, "range int, at int, low double, high double")
    return cells.join(F.broadcast(table), "at").where(F.col("reading").between(F.col("low"), F.col("high")))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles: `(column_name, probability, quantile)`.

    Selection by repeated histograms. A mergeable sketch of each column gives points around the wanted ranks;
    how many values lie at and between them is counted exactly, and the part that holds a rank takes the place
    of the column. That is repeated until a part is one value or has few of them, which are then read. Each
    round leaves about a four-hundredth of the values, whatever their distribution, and always fewer, as
    points are values themselves; a sketch that misses costs a round, not the result. No values are ordered, and
    all that is shuffled is sketches and counts of each task.

    The rounds run when this is called, and read `df` twice each: store it first where it is no stored table.
    Some numbers per column and probability reach the driver. Columns without values have no row. Nulls are
    ignored, NaN is the largest value.
    """
    spark = df.sparkSession
    # Columns go by position up to the end: a number is cheaper than a name to group and sort by.
    cells = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("at"), F.col(f"`{c}`").cast("double").alias("reading"))
                    for i, c in enumerate(columns)
                ]
            )
        )
    ).where(F.col("reading").isNotNull())
    grid = [i / SKETCH_POINTS for i in range(SKETCH_POINTS + 1)]

    def points(value: Column) -> Column:
        return F.percentile_approx(value, grid, SKETCH_ACCURACY).alias("points")

    number = F.when(~F.isnan("reading"), F.col("reading"))
    first = cells.groupBy("at").agg(F.count("*").alias("total"), F.count(number).alias("numbers"), points(number)).collect()
    totals = {row["at"]: row["total"] for row in first}
    wanted: dict[tuple[int, float], tuple[int, int, float]] = {}
    found: dict[tuple[int, int], float] = {}
    ranges, sketches = [], []
    for row in first:
        at, ranks = row["at"], set()
        for p in probabilities:
            position = (totals[at] - 1) * float(p)
            wanted[at, float(p)] = floor(position), ceil(position), position - floor(position)
            ranks.update(wanted[at, float(p)][:2])
        found.update({(at, r): nan for r in ranks if r >= row["numbers"]})
        ranks = {r for r in ranks if r < row["numbers"]}
        if ranks:
            ranges.append(_Range(at, -inf, inf, 0, row["numbers"], ranks))
            sketches.append(row["points"])
    few: list[_Range] = []
    while ranges:
        parts: list[_Range] = []
        parents: list[int] = []
        for i, (r, sketch) in enumerate(zip(ranges, sketches, strict=True)):
            made = [r] if r.n <= FEW_VALUES else r.cut(sketch)
            parts += made
            parents += [i] * len(made)
        counting = [i for i, p in enumerate(parts) if p is not ranges[parents[i]]]
        counts = [0] * len(counting)
        if counting:
            met = _in_ranges(cells, [parts[i] for i in counting])
            for row in met.groupBy("range").agg(F.count("*").alias("n")).collect():
                counts[row["range"]] = row["n"]
        for i, n in zip(counting, counts, strict=True):
            parts[i].n = n
        left, before, parent = [], 0, -1
        for part, above in zip(parts, parents, strict=True):
            whole = ranges[above]
            if part is whole:
                few.append(part)
                continue
            if above != parent:
                parent, before = above, whole.before
            part.before, before = before, before + part.n
            part.ranks = {r for r in whole.ranks if part.before <= r < before}
            if part.low == part.high:
                found.update({(part.at, r): part.low for r in part.ranks})
            elif part.ranks:
                left.append(part)
        few += [r for r in left if r.n <= FEW_VALUES]
        ranges, sketches = [r for r in left if r.n > FEW_VALUES], []
        if ranges:
            held = _in_ranges(cells, ranges).groupBy("range").agg(points(F.col("reading"))).collect()
            sketches = [row["points"] for row in sorted(held, key=lambda row: row["range"])]
    if few:
        # At most FEW_VALUES of a range.
        values: dict[int, list[float]] = {}
        for row in _in_ranges(cells, few).groupBy("range").agg(F.collect_list("reading").alias("values")).collect():
            values[row["range"]] = sorted(row["values"])
        for i, r in enumerate(few):
            found.update({(r.at, rank): values[i][rank - r.before] for rank in r.ranks})
    lines = []
    for (at, p), (low, high, share) in wanted.items():
        below, above = found[at, low], found[at, high]
        lines.append((columns[at], p, below if below == above else below + (above - below) * share))
    schema = "column_name string, probability double, quantile double"
    return _literal_rows(spark, lines, schema) if lines else spark.createDataFrame([], schema)


def sort_rows(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """Total sort, by ranges. For use right before a sink.

    Rows that are equal in all sort columns share a task, so name columns that tell rows apart.
    """
    return df.orderBy(*columns)


def first_rows(df: DataFrame, columns: Sequence[str | Column], n: int) -> DataFrame:
    """The first `n` rows in key order. Each task keeps only its own first `n`."""
    return df.orderBy(*columns).limit(n)


def any_rows(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def top_by_count(counts: DataFrame, count_col: str, ties: Sequence[str], n: int) -> DataFrame:
    """The `n` largest counts, ties in key order."""
    return first_rows(counts, [F.col(count_col).desc(), *ties], n)

"""Profiles of a table. Each is one aggregation whose partial results are made before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicepulse.operators.ranking import exact_quantiles, top_by_count
from devicepulse.spec import TelemetrySpec, numeric_cols


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _per_column(df: DataFrame, measures: dict[str, dict[str, Column]]) -> DataFrame:
    """Aggregate once over the table, then lay the one row out as a row per column."""
    kinds = list(next(iter(measures.values())))
    row = df.agg(*[m.alias(f"{k}_{i}") for i, ms in enumerate(measures.values()) for k, m in ms.items()])
    packed = row.select(
        F.array(*[F.lit(c) for c in measures]).alias("column_name"),
        *[F.array(*[F.col(f"{k}_{i}") for i in range(len(measures))]).alias(k) for k in kinds],
    )
    return packed.select(F.inline(F.arrays_zip("column_name", *kinds)))


def _cells(df: DataFrame, values: Sequence[dict[str, Column]]) -> DataFrame:
    """A short row per cell: the position of its column (`at`) and its value."""
    lines = [
        F.struct(F.lit(i).alias("at"), *[v.alias(k) for k, v in value.items()])
        for i, value in enumerate(values)
    ]
    return df.select(F.inline(F.array(*lines)))


def _named(df: DataFrame, columns: Sequence[str], by_position: DataFrame) -> DataFrame:
    """Column names in place of positions; a column without cells has a row all the same."""
    names = df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(c) for c in columns])).alias("at", "column_name")
    )
    return names.join(by_position, "at", "left").drop("at")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def schema_profile(df: DataFrame) -> DataFrame:
    """Position, name, type, rows and non-null rows of every column."""
    types = dict(df.dtypes)
    return _per_column(
        df,
        {
            c: {
                "position": F.any_value(F.lit(i)),
                "data_type": F.any_value(F.lit(types[c])),
                "rows": F.count("*"),
                "non_null": F.count(_c(c)),
            }
            for i, c in enumerate(df.columns)
        },
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and null fraction of every column. The fraction is null on empty input.

    NaN is not null: clean the sentinels first.
    """
    missing = F.col("rows") - F.col("present")
    profile = _per_column(df, {c: {"rows": F.count("*"), "present": F.count(_c(c))} for c in df.columns})
    return profile.select(
        "column_name",
        missing.alias("null_count"),
        F.try_divide(missing, "rows").alias("null_fraction"),
    )


def null_fractions(df: DataFrame) -> dict[str, float | None]:
    """The fractions on the driver: one row of one number per column."""
    rows, *present = df.agg(F.count("*"), *[F.count(_c(c)) for c in df.columns]).first()
    return {c: (rows - n) / rows if rows else None for c, n in zip(df.columns, present, strict=True)}


def _lane(field: T.StructField) -> tuple[str, Column]:
    """Which of three plain columns can hold every value of the field apart, and the value there."""
    column, kind = _c(field.name), field.dataType
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return "whole", column.cast("bigint")
    if isinstance(kind, T.DateType):
        return "whole", F.unix_date(column).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return "whole", F.unix_micros(column)
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return "real", column.cast("double")
    if isinstance(kind, T.BinaryType):
        return "text", F.hex(column)
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return "text", F.to_json(column)
    return "text", column.cast("string")


def cells_by_lane(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """A short row per cell: the `keep` columns, `column_name`, and the value as `whole`, `real` or `text`. Columns
    named in `keep` are cells too."""
    empty = {"whole": "bigint", "real": "double", "text": "string"}
    lines = []
    for field in df.schema.fields:
        lane, value = _lane(field)
        parts = [(value if e == lane else F.lit(None).cast(t)).alias(e) for e, t in empty.items()]
        lines.append(F.struct(F.lit(field.name).alias("column_name"), *parts))
    return df.select(*[_c(k) for k in keep], F.inline(F.array(*lines)))


def distinct_profile(df: DataFrame, approximate: bool = False, rsd: float = 0.02) -> DataFrame:
    """Distinct values of every column, exact or by a sketch per column.

    Each cell becomes a short row of its column's position and its value. A distinct count per
    column in one aggregation would instead carry all columns in every such row, and fails to
    scale with the width. Values are folded before the shuffle, so a value that most rows hold
    is one row per task. For the constant test, `constant_flags` needs neither.
    """
    empty = {"whole": "bigint", "real": "double", "text": "string"}
    lanes = {f.name: _lane(f) for f in df.schema.fields}
    used = [lane for lane in empty if lane in {lane for lane, _ in lanes.values()}]
    cells = _cells(
        df,
        [
            {u: value if u == lane else F.lit(None).cast(empty[u]) for u in used}
            for lane, value in lanes.values()
        ],
    )
    present = reduce(Column.__or__, [F.col(u).isNotNull() for u in used])
    if approximate:
        value = F.when(present, F.xxhash64(*used))
        counts = cells.groupBy("at").agg(F.approx_count_distinct(value, rsd).alias("n"))
    else:
        counts = cells.groupBy("at", *used).agg(F.count("*")).groupBy("at").agg(F.count_if(present).alias("n"))
    return _named(df, df.columns, counts).select(
        "column_name", F.coalesce("n", F.lit(0).cast("bigint")).alias("distinct_count")
    )


def _is_constant(name: str) -> Column:
    return F.coalesce(F.min(_c(name)) == F.max(_c(name)), F.lit(True))


def constant_profile(df: DataFrame) -> DataFrame:
    """Whether a column has fewer than two distinct values, by minimum and maximum: one pass,
    no distinct count."""
    return _per_column(df, {c: {"is_constant": _is_constant(c)} for c in df.columns})


def constant_flags(df: DataFrame) -> dict[str, bool]:
    row = df.agg(*[_is_constant(c) for c in df.columns]).first()
    return dict(zip(df.columns, row, strict=True))


def date_range(df: DataFrame, spec: TelemetrySpec) -> DataFrame:
    return df.agg(
        F.min(spec.date_col).alias("first_date"),
        F.max(spec.date_col).alias("last_date"),
    )


def distinct_count(df: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """Distinct values (or combinations) of the columns, among the rows that pass `where`."""
    rows = df if where is None else df.where(where)
    return rows.agg(F.count_distinct(*[_c(c) for c in columns]).alias("distinct_count"))


def failing_device_count(df: DataFrame, spec: TelemetrySpec, by: Sequence[str] | None = None) -> DataFrame:
    """Distinct devices with a failing row."""
    return distinct_count(df, by or spec.ids, F.col(spec.target_col) == 1)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("rows"))


def class_counts(df: DataFrame, spec: TelemetrySpec) -> DataFrame:
    return value_counts(df, [spec.target_col])


def class_shares(df: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """Rows and percentage of each class. The total is a scalar subquery over the class table."""
    counts = class_counts(df, spec)
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("percent", F.col("rows") * 100.0 / total)


def rows_per_device(df: DataFrame, spec: TelemetrySpec) -> DataFrame:
    return value_counts(df, spec.ids)


def failing_devices_by(df: DataFrame, spec: TelemetrySpec, by: Sequence[str]) -> DataFrame:
    """Failing devices per value of `by`, for example per model."""
    failing = df.where(F.col(spec.target_col) == 1).select(*spec.ids).distinct()
    return failing.groupBy(*by).agg(F.count("*").alias("devices"))


def gap_variety(gaps: DataFrame, spec: TelemetrySpec, gap_col: str = "gap_days") -> DataFrame:
    """Distinct gap lengths of each device that has a gap at all."""
    present = gaps.where(F.col(gap_col).isNotNull())
    return present.groupBy(*spec.ids).agg(F.count_distinct(gap_col).alias("gap_lengths"))


# Buckets of keys whose rows are counted together, to bound the counts of the keys in them.
COUNT_BUCKETS = 1 << 16


def top_counts(df: DataFrame, columns: Sequence[str], n: int, buckets: int = COUNT_BUCKETS) -> DataFrame:
    """The `n` most frequent values with their `rows`, most first, ties in key order: the first of `value_counts`.

    Rows are first counted per bucket of a hash of the key, which moves a number per bucket and task. No key
    has more rows than its bucket. The keys of the largest buckets are counted exactly, and the n-th of those
    counts bars every bucket that has fewer rows; only keys of the others, ties included, are counted and moved.
    Where counts are so even that half of the rows are left, all keys are counted. The bar is found when this
    is called; a number per bucket reaches the driver.
    """
    bucket = F.pmod(F.xxhash64(*[_c(c) for c in columns]), F.lit(buckets)).cast("int")
    keys = df.select(*[_c(c) for c in columns], bucket.alias("_bucket"))
    held = keys.groupBy("_bucket").agg(F.count("*").alias("rows")).collect()
    sizes = sorted(((row["rows"], row["_bucket"]) for row in held), reverse=True)

    def counted(numbers: Sequence[int]) -> DataFrame:
        rows = _in_buckets(keys, numbers)
        return value_counts(rows.drop("_bucket"), columns)

    first = counted([b for _, b in sizes[: 4 * n]])
    best = [row["rows"] for row in top_by_count(first, "rows", columns, n).select("rows").collect()]
    bar = best[n - 1] if len(best) == n else 0
    left = [(rows, b) for rows, b in sizes if rows >= bar]
    if 2 * sum(rows for rows, _ in left) >= sum(rows for rows, _ in sizes):
        return top_by_count(value_counts(df, columns), "rows", columns, n)
    return top_by_count(counted([b for _, b in left]), "rows", columns, n)


def _in_buckets(keys: DataFrame, numbers: Sequence[int]) -> DataFrame:
    chosen = keys.sparkSession.range(1).coalesce(1).select(
        F.explode(F.from_json(F.lit(str(list(numbers))), "array<int>")).alias("_bucket")
    )
    # At most a number per bucket.
    return keys.join(F.broadcast(chosen), "_bucket", "left_semi")


def class_means(df: DataFrame, spec: TelemetrySpec, columns: Sequence[str] | None = None) -> DataFrame:
    columns = columns or spec.numeric_feature_cols(df)
    return df.groupBy(spec.target_col).agg(*[F.mean(_c(c)).alias(c) for c in columns])


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of the numeric columns."""
    return _moments(df, list(columns or numeric_cols(df)), {})


def _moments(df: DataFrame, columns: list[str], more: dict[str, Column]) -> DataFrame:
    cells = _cells(df, [{"reading": _c(c).cast("double")} for c in columns])
    measures = {
        "rows": F.count("reading"),
        "mean": F.avg("reading"),
        "stddev": F.stddev("reading"),
        "min": F.min("reading"),
        "max": F.max("reading"),
        **more,
    }
    profile = cells.groupBy("at").agg(*[m.alias(k) for k, m in measures.items()])
    return _named(df, columns, profile).na.fill(0, ["rows"])


def summary(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False, accuracy: int = 10000
) -> DataFrame:
    """The same plus quartiles: by one sketch per column in the same pass, or exact and interpolated."""
    columns, points = list(columns or numeric_cols(df)), list(QUARTILES.values())
    if not exact:
        sketch = F.percentile_approx("reading", points, accuracy)
        profile = _moments(df, columns, {"quartiles": sketch})
        at = {k: F.col("quartiles").getItem(i) for i, k in enumerate(QUARTILES)}
        return profile.withColumns(at).drop("quartiles")
    quartiles = exact_quantiles(df, columns, points)
    wide = quartiles.groupBy("column_name").agg(
        *[
            F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(k)
            for k, p in QUARTILES.items()
        ]
    )
    return describe(df, columns).join(wide, "column_name", "left")


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()

"""Duplicate removal with a result that does not depend on how rows are spread."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devicepulse.spec import TelemetrySpec


def one_row_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Keep the first row of each key in `order` (default: all other columns, ascending).

    The order should be total, so that the kept row is always the same. Spark cuts each key to
    one row inside every map task before the shuffle (window group limit), so a key that holds
    a large share of all rows sends at most one row per task.
    """
    if order is None:
        order = [c for c in df.columns if c not in keys]
    order = list(order) or list(keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


# Bits of the filter of repeated keys: 1 MB, which every task gets whatever the table.
FILTER_BITS = 1 << 23
_HASHES = (0, 1, 2)


def _bits(keys: Sequence[str], bits: int) -> list[Column]:
    """The bits that stand for a key. Null is a key like any other."""
    # The number of the hash comes first: a null leaves the hash of what is before it as it is.
    return [F.pmod(F.xxhash64(F.lit(i), *[F.col(f"`{k}`") for k in keys]), F.lit(bits)) for i in _HASHES]


def key_filter(table: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS) -> Column:
    """A Bloom filter of the keys of a table, as a scalar column: an array of words of 64 bits.

    Bits are folded to words in the map tasks, so no task gets more than `bits` / 64 rows of another.
    """
    marks = table.select(F.explode(F.array(*_bits(keys, bits))).alias("bit"))
    word = F.shiftright("bit", 6).alias("word")
    mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("bit") % 64).cast("int"))
    # Every word once, so that a word's place in the array is its number.
    every = table.sparkSession.range(0, bits // 64, 1, 1).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("mark"))
    words = marks.select(word, mark.alias("mark")).unionByName(every).groupBy("word").agg(F.bit_or("mark").alias("mark"))
    in_order = F.sort_array(F.collect_list(F.struct("word", "mark")))
    return words.agg(F.transform(in_order, lambda w: w["mark"])).scalar()


def may_hold(words: Column, keys: Sequence[str], bits: int = FILTER_BITS) -> Column:
    """Whether a row's key may be among those of the filter. Never false for one that is."""
    found = F.lit(True)
    for bit in _bits(keys, bits):
        word = F.get(words, F.shiftright(bit, 6).cast("int"))
        found = found & (F.bit_get(word, (bit % 64).cast("int")) == 1)
    return found


def one_row_per_mostly_unique_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] | None = None,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """The same rows as `one_row_per_key`, for a wide table with few repeated keys.

    The repeated keys are found on the key columns alone and marked in a Bloom filter of a fixed size, which
    is applied at the scan. Rows it does not let through have a key of their own and stay as they are; only
    the others, the repeated ones and a few that look like them, are shuffled and compared. The more keys are
    repeated the more rows pass: at a tenth as many as the filter has bits a fiftieth of the others do, and far
    above that all, which then costs what `one_row_per_key` does.
    """
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > 1)
    candidate = may_hold(key_filter(repeated, keys, bits), keys, bits)
    # An empty table has an empty filter, not a null one, so both sides together are all rows.
    return df.where(~candidate).unionByName(one_row_per_key(df.where(candidate), keys, order))


def failing_first(df: DataFrame, spec: TelemetrySpec) -> list[str | Column]:
    """Highest target first, ties broken by all other columns."""
    others = [c for c in df.columns if c not in [*spec.day_key, spec.target_col]]
    return [F.col(spec.target_col).desc(), *others] if spec.target_col in df.columns else others


def one_row_per_day(
    df: DataFrame,
    spec: TelemetrySpec,
    order: Sequence[str | Column] | None = None,
    mostly_unique: bool = False,
) -> DataFrame:
    """Keep one row per device and day, by default the failing one: a failure reported twice, once
    as 0 and once as 1, stays a failure. `mostly_unique` says that few device-days are repeated.
    """
    order = failing_first(df, spec) if order is None else order
    keep = one_row_per_mostly_unique_key if mostly_unique else one_row_per_key
    return keep(df, spec.day_key, order)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Drop exact duplicates."""
    return df.distinct()


def first_row_per_gap(gaps: DataFrame, spec: TelemetrySpec, gap_col: str = "gap_days") -> DataFrame:
    """First occurrence of each gap length of each device, a missing gap counting as one day."""
    filled = gaps.na.fill(1, subset=[gap_col])
    return one_row_per_key(filled, [*spec.ids, gap_col], [spec.date_col])

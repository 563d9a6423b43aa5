"""Profiles of a growing table, from a stored state per day.

A day's state has a short row per column: how many rows and known values, extremes, and a sketch of the values. The
values themselves can be kept too, each once a day, where exact distinct counts are wanted. States of days
add up to the state of all of them, so a profile reads states, not the table, and a day that is
delivered again replaces its own state alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicepulse.operators.profiling import cells_by_lane
from devicepulse.sources import write_table

SKETCH_BITS = 14  # a standard error of 0.8 percent
_LANES = ("whole", "real", "text")


def _any() -> Column:
    return F.col("whole").isNotNull() | F.col("real").isNotNull() | F.col("text").isNotNull()


def day_states(df: DataFrame, day: str) -> DataFrame:
    """`(day, column_name, rows, present, sketch, least and most of each kind of value)`, folded in the map tasks."""
    value = F.when(_any(), F.xxhash64(*_LANES))
    extremes = [f(lane).alias(f"{name}_{lane}") for lane in _LANES for name, f in (("least", F.min), ("most", F.max))]
    return (
        cells_by_lane(df, [day])
        .groupBy(F.col(day), "column_name")
        .agg(
            F.count("*").alias("rows"),
            F.count_if(_any()).alias("present"),
            F.hll_sketch_agg(value, SKETCH_BITS).alias("sketch"),
            *extremes,
        )
    )


def day_values(df: DataFrame, day: str) -> DataFrame:
    """`(day, column_name, whole, real, text)`: the known values of each day, each once."""
    return cells_by_lane(df, [day]).where(_any()).select(day, "column_name", *_LANES).distinct()


def save_days(states: DataFrame, path: str, day: str) -> None:
    """Write the states of some days, which take the place of those days' earlier ones; others stay."""
    spark, option = states.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(option)
    spark.conf.set(option, "dynamic")
    try:
        write_table(states, path, mode="overwrite", partition_by=[day])
    finally:
        spark.conf.set(option, before)


def merged_profile(states: DataFrame, values: DataFrame | None = None) -> DataFrame:
    """Nulls, constant columns and distinct values of all days together: `(column_name, rows, null_count,
    null_fraction, is_constant, distinct_count)`. Distinct counts are those of merged sketches, or exact with
    `values`. Columns that only some days have count as null on the others."""
    extremes = [f(f"{name}_{lane}").alias(f"{name}_{lane}") for lane in _LANES for name, f in (("least", F.min), ("most", F.max))]
    merged = states.groupBy("column_name").agg(
        F.sum("present").alias("present"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_count"), *extremes
    )
    # Every day has as many rows as its columns say; a column that a day lacks has none there.
    days = states.groupBy([c for c in states.columns if c not in _state_columns()]).agg(F.max("rows").alias("rows"))
    total = days.agg(F.coalesce(F.sum("rows"), F.lit(0))).scalar()
    one_value = F.lit(True)
    for lane in _LANES:
        one_value = one_value & F.coalesce(F.col(f"least_{lane}") == F.col(f"most_{lane}"), F.lit(True))
    profile = merged.select(
        "column_name",
        total.alias("rows"),
        (total - F.col("present")).alias("null_count"),
        F.try_divide(total - F.col("present"), total).alias("null_fraction"),
        one_value.alias("is_constant"),
        "distinct_count",
    )
    if values is None:
        return profile
    exact = values.select("column_name", *_LANES).distinct().groupBy("column_name").agg(F.count("*").alias("exact"))
    joined = profile.drop("distinct_count").join(exact, "column_name", "left")
    return joined.withColumn("distinct_count", F.coalesce("exact", F.lit(0).cast("bigint"))).drop("exact")


def _state_columns() -> set[str]:
    return {"column_name", "rows", "present", "sketch", *[f"{n}_{lane}" for n in ("least", "most") for lane in _LANES]}

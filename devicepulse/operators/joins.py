"""Equi-joins between the telemetry table and tables derived from it.

No side is hinted: Spark broadcasts a side whose measured size allows it, and otherwise sorts and
merges, with skewed partitions of the left side split at run time. The right side is folded to one
row per key, before its shuffle, so that no join multiplies rows and no key is hot on both sides. A missing key
is a key like any other: null meets null, as it does in windows and groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicepulse.spec import DEVICE_HASH, TelemetrySpec


def _same(df: DataFrame, other: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """Equi-join on columns of the same names, null-safe; the key stands once, as by a join on names."""
    renamed = other.withColumnsRenamed({k: f"_right_{k}" for k in key})
    # The hash of the device is never null. A plain comparison keeps the layout of tables that are laid out by it.
    same = [
        F.col(k) == F.col(f"_right_{k}") if k == DEVICE_HASH else F.col(k).eqNullSafe(F.col(f"_right_{k}"))
        for k in key
    ]
    joined = df.join(renamed, same, how).drop(*[f"_right_{k}" for k in key])
    return joined.select(*key, *[c for c in joined.columns if c not in key])


def attach_cycle_starts(gaps: DataFrame, starts: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """The gap table with the columns of the rows that open a cycle, null elsewhere."""
    return _same(gaps, starts, [*spec.day_key, "gap_days"], "left")


def attach_target(cycles: DataFrame, df: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """The cycle table with the target of each device-day: the highest, where `df` repeats a day."""
    targets = df.groupBy(*spec.day_key).agg(F.max(spec.target_col).alias(spec.target_col))
    return _same(cycles, targets, spec.day_key, "left")


def rows_of_failed_cycles(cycles: DataFrame, df: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """All rows of the cycles that hold a failing row, by join. `df` may be any table that has
    the failing device-days; only those are shuffled.
    """
    failing = df.where(F.col(spec.target_col) == 1).select(*spec.day_key)
    return members(cycles, members(cycles, failing, spec.day_key), spec.cycle_key)


def with_cycle_columns(
    df: DataFrame, cycles: DataFrame, spec: TelemetrySpec, how: str = "inner"
) -> DataFrame:
    """Telemetry with the cycle columns of its device-days: only those that have a cycle row
    (`inner`), or all (`left`).
    """
    return _same(df, cycles, spec.day_key, how)


def members(df: DataFrame, chosen: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is among the chosen, each once."""
    return _same(df, chosen.select(*key).distinct(), list(key), "left_semi").select(*df.columns)

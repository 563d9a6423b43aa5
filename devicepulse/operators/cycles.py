"""Cycles: runs of a device's days without a gap of more than `gap_days`.

Every window here is partitioned by the device and runs over device-days, of which a device has
at most one per calendar day. So a window group is bounded by the length of the calendar even
where one device holds a large share of the raw rows; those are folded to device-days first, with
the folding done inside the map tasks.

All of gaps, cycles, failed cycles and lags hash on the device, hence one shuffle serves them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from devicepulse.functions import day_gap
from devicepulse.operators.ranking import running_total
from devicepulse.spec import TelemetrySpec


def device_days(df: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """The distinct device-days of any table that has them."""
    return df.select(*spec.day_key).distinct()


def _by_date(spec: TelemetrySpec) -> WindowSpec:
    return Window.partitionBy(*spec.ids).orderBy(spec.date_col)


def _whole_cycle(spec: TelemetrySpec) -> WindowSpec:
    # Ordered although the aggregate needs no order, so as to share the sort with the lags.
    return (
        Window.partitionBy(*spec.cycle_key)
        .orderBy(spec.date_col)
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )


def _unless_repeated(value: Column, window: WindowSpec, spec: TelemetrySpec) -> Column:
    """The value, or an error where the row before it in the window has the same date.

    Which of two rows of one day comes first is undefined, so whatever is built on their order
    would be too, and only unique days bound a window group.
    """
    repeated = F.lag(spec.date_col).over(window) == F.col(spec.date_col)
    error = F.raise_error(F.lit(f"several rows for one {spec.day_key}: keep one row per day first"))
    return F.when(repeated, error).otherwise(value)


def previous_day(days: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """Add the date of the device's previous row."""
    by_date = _by_date(spec)
    previous = F.lag(spec.date_col).over(by_date)
    return days.withColumn("previous_date", _unless_repeated(previous, by_date, spec))


def day_gaps(days: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """Add the days since the device's previous row, null on its first."""
    by_date = _by_date(spec)
    gap = day_gap(F.col(spec.date_col), F.lag(spec.date_col).over(by_date))
    return days.withColumn("gap_days", _unless_repeated(gap, by_date, spec))


def with_cycles(days: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """Add `cycle_seq` (1, 2, … within the device) and `cycle_start` to a table that has one row
    per device-day. Every gap over `gap_days` opens a cycle, and none crosses devices.

    `(device, cycle_seq)` names a cycle everywhere; `number_cycles` adds one number across
    devices for those who need it.
    """
    so_far = _by_date(spec).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gapped = day_gaps(days, spec)
    opens = F.col("gap_days").isNull() | (F.col("gap_days") > spec.gap_days)
    return gapped.withColumns(
        {
            spec.cycle_seq_col: F.sum(F.when(opens, 1).otherwise(0)).over(so_far),
            spec.cycle_start_col: F.max(F.when(opens, F.col(spec.date_col))).over(so_far),
        }
    ).drop("gap_days")


def cycle_rows(df: DataFrame, spec: TelemetrySpec, unique_days: bool = False) -> DataFrame:
    """Device, day, `cycle_seq` and `cycle_start` of any telemetry table.

    Only the key columns are read. `unique_days` says that device-days are already unique, which
    saves a shuffle.
    """
    days = df.select(*spec.day_key) if unique_days else device_days(df, spec)
    return with_cycles(days, spec)


def number_cycles(cycles: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """Add `cycle_id`: 1, 2, … over all cycles, by device and first date.

    The number of a device's first cycle is one more than the cycles of all devices before it.
    That running total is taken over one row per device. The cycle rows are read twice: store
    them first where they are not a stored table (`pin`).
    """
    per_device = cycles.groupBy(*spec.ids).agg(F.max(spec.cycle_seq_col).alias("_cycles"))
    counted = running_total(per_device, spec.ids, F.col("_cycles"), "_through")
    before = counted.select(*spec.ids, (F.col("_through") - F.col("_cycles")).alias("_before"))
    same_device = [cycles[c].eqNullSafe(before[c]) for c in spec.ids]
    return cycles.join(before, same_device).select(
        *[cycles[c] for c in cycles.columns],
        (before["_before"] + cycles[spec.cycle_seq_col]).alias(spec.cycle_id_col),
    )


def cycle_starts(cycles: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """The first row of each cycle."""
    return cycles.where(F.col(spec.date_col) == F.col(spec.cycle_start_col))


def forward_fill(days: DataFrame, columns: Sequence[str], spec: TelemetrySpec) -> DataFrame:
    """Carry the last known value forward over the device's later days."""
    by_date = _by_date(spec)
    so_far = by_date.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.withColumns(
        {c: _unless_repeated(F.last(c, ignorenulls=True).over(so_far), by_date, spec) for c in columns}
    )


def with_failed_flag(rows: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """Add `cycle_failed`: whether any row of the cycle carries the target."""
    worst = F.max(spec.target_col).over(_whole_cycle(spec))
    return rows.withColumn("cycle_failed", F.coalesce(worst == 1, F.lit(False)))


def keep_failed_cycles(rows: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """All rows of the cycles that hold a failing row, by window: no join, no further shuffle."""
    return with_failed_flag(rows, spec).where("cycle_failed").drop("cycle_failed")


def lag_features(
    rows: DataFrame,
    spec: TelemetrySpec,
    num_lags: int | None = None,
    no_lag_cols: Sequence[str] | None = None,
    cycle_key: Sequence[str] | None = None,
) -> DataFrame:
    """Add `<column>_lag_<k>` for k = 1 … `num_lags` within the cycle, for every column that is
    not in `no_lag_cols` (default: the reserved ones). One projection, one window.
    """
    num_lags = spec.num_lags if num_lags is None else num_lags
    no_lag_cols = spec.reserved if no_lag_cols is None else no_lag_cols
    in_cycle = Window.partitionBy(*(cycle_key or spec.cycle_key)).orderBy(spec.date_col)
    lags = {
        f"{c}_lag_{k}": F.lag(c, k).over(in_cycle)
        for c in rows.columns
        if c not in no_lag_cols
        for k in range(1, num_lags + 1)
    }
    for first in list(lags)[:1]:
        lags[first] = _unless_repeated(lags[first], in_cycle, spec)
    return rows.select("*", *[lag.alias(name) for name, lag in lags.items()])

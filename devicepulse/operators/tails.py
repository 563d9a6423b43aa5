"""Cycles and lags of new days, going on from the last days of each device.

A tail holds the last rows of every device's current cycle, as many as there are lags, with their cycle. New days come
after it, so cycles and lags of the new days are the ones that the whole history would give, and only tails and new
days are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from devicepulse.functions import day_gap
from devicepulse.operators.cycles import lag_features, with_cycles
from devicepulse.spec import TelemetrySpec

NEW = "_new"


def continued(tail: DataFrame | None, new_days: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """Rows of the tail and of the new days with their cycles; `NEW` tells them apart.

    Both have one row per device-day. A new day that is not after its device's tail fails the query: what
    came after it has been answered already. Without a tail the history begins here.
    """
    if tail is None:
        return with_cycles(new_days, spec).withColumn(NEW, F.lit(True))
    old = tail.withColumn(NEW, F.lit(False))
    seq, start = spec.cycle_seq_col, spec.cycle_start_col
    new = new_days.withColumns(
        {
            NEW: F.lit(True),
            seq: F.lit(None).cast(tail.schema[seq].dataType),
            start: F.lit(None).cast(tail.schema[start].dataType),
        }
    )
    both = old.unionByName(new)
    device = Window.partitionBy(*spec.ids).orderBy(spec.date_col)
    so_far = device.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gap = day_gap(F.col(spec.date_col), F.lag(spec.date_col).over(device))
    late = ((~F.col(NEW)) & F.lag(NEW).over(device)) | (gap == 0)
    error = F.raise_error(F.lit("a day is not after the stored tail of its device")).cast("int")
    marked = both.withColumn(
        "_opens", F.when(late, error).otherwise((F.col(NEW) & (gap.isNull() | (gap > spec.gap_days))).cast("int"))
    )
    opened = F.sum("_opens").over(so_far)
    before = F.coalesce(F.max(seq).over(so_far), F.lit(0))
    began = F.max(F.when(F.col("_opens") == 1, F.col(spec.date_col)).otherwise(F.col(start))).over(so_far)
    # The running maximum of a new row sees the tail alone, as new rows have no number of their own yet.
    return marked.withColumns(
        {seq: F.when(F.col(NEW), before + opened).otherwise(F.col(seq)), start: F.when(F.col(NEW), began).otherwise(F.col(start))}
    ).drop("_opens")


def new_rows_with_lags(rows: DataFrame, spec: TelemetrySpec, no_lag_cols: list[str]) -> DataFrame:
    """The new days of `continued` with their lags."""
    lagged = lag_features(rows, spec, no_lag_cols=[*no_lag_cols, NEW])
    return lagged.where(F.col(NEW)).drop(NEW)


def latest(rows: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """The tail after the rows of `continued`: of each device the last `num_lags` rows (one at least) of its last
    cycle. Spark keeps only so many of a device in each task before the shuffle."""
    last = Window.partitionBy(*spec.ids).orderBy(F.col(spec.date_col).desc())
    ranked = rows.drop(NEW).withColumn("_place", F.row_number().over(last))
    kept = ranked.where(F.col("_place") <= max(spec.num_lags, 1))
    current = F.max(spec.cycle_seq_col).over(Window.partitionBy(*spec.ids))
    return kept.withColumn("_current", current).where(F.col(spec.cycle_seq_col) == F.col("_current")).drop("_place", "_current")

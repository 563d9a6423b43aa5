"""Gaps, cycles, lags, the joins around them, sorts and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicepulse.operators import cycles, dedup, joins, profiling, ranking, splitting
from devicepulse.sources import Buckets, commit_table, pin, read_current, scratch_path
from devicepulse.spec import DEVICE_HASH
from devicepulse.workload import views
from devicepulse.workload.registry import query
from devicepulse.workload.storage import bucket
from devicepulse.workload.views import SPEC

_READINGS = f"WITH {views.READINGS_SQL} "
_DAYS = f"WITH {views.DAYS_SQL} "
_CYCLES = f"WITH {views.CYCLES_SQL} "
_LAGS = f"WITH {views.LAGS_SQL} "
_KEY = "user_id, device_model, date"
_ROW = f"{_KEY}, failure, reading, hour, cycle_seq, cycle_start"
_LAG_COLS = ", ".join(f"{c}_lag_{k}" for c in views.FEATURES for k in (1, 2, 3))


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.device_days(views.readings(spark, sf_dir), SPEC)


def _cycle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.cycle_rows(views.readings(spark, sf_dir), SPEC)


@query(
    _DAYS
    + f"""SELECT {_KEY}, lag(date) OVER (PARTITION BY user_id, device_model ORDER BY date) AS previous_date
FROM days"""
)
def win1_previous_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.previous_day(_days(spark, sf_dir), SPEC)


@query(_CYCLES + f"SELECT {_KEY}, gap_days FROM gaps")
def win2_day_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.day_gaps(_days(spark, sf_dir), SPEC)


@query(_CYCLES + f"SELECT {_KEY}, cycle_seq, cycle_start FROM cyc")
def win3_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cycle_rows(spark, sf_dir)


@query(
    "WITH "
    + views.SHIPMENT_DAYS_SQL
    + """,
g AS (SELECT *, CAST(l_shipdate - lag(l_shipdate) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate)
             AS INTEGER) AS gap FROM shipment_days)
SELECT l_suppkey, l_shipdate, failure, quantity, price, discount, tax,
  CAST(sum(CASE WHEN gap IS NULL OR gap > 7 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS cycle_seq,
  max(CASE WHEN gap IS NULL OR gap > 7 THEN l_shipdate END) OVER w AS cycle_start
FROM g WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
)
def win3_cycles_wide_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another table, another key, a gap of a week."""
    return cycles.with_cycles(views.shipment_days(spark, sf_dir), views.SHIPMENTS)


@query(
    _CYCLES
    + f"""SELECT {_KEY}, cycle_seq, cycle_start,
  dense_rank() OVER (ORDER BY user_id, device_model, cycle_start) AS cycle_id FROM cyc"""
)
def win4_cycle_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.number_cycles(pin(_cycle_rows(spark, sf_dir)), SPEC)


@query(
    _CYCLES
    + f"""SELECT {_KEY}, cycle_seq, row_number() OVER (ORDER BY user_id, device_model, date) AS cycle_id
FROM cyc WHERE date = cycle_start"""
)
def win4_numbered_cycle_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cycle table itself, numbered in key order."""
    starts = cycles.cycle_starts(_cycle_rows(spark, sf_dir), SPEC).drop("cycle_start")
    return ranking.dense_number(starts, SPEC.day_key, "cycle_id")


@query(
    _READINGS
    + """SELECT event_id, date, sparse AS known,
  last_value(sparse IGNORE NULLS) OVER w AS sparse, last_value(firmware IGNORE NULLS) OVER w AS firmware,
  last_value(CASE WHEN event_id % 997 = 5 THEN reading END IGNORE NULLS) OVER w AS rare
FROM readings WINDOW w AS (ORDER BY date, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
)
def win5_fill_over_the_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In one order over all devices; `rare` is known so seldom that whole ranges lack it."""
    rows = views.readings(spark, sf_dir).select(
        "event_id",
        "date",
        F.col("sparse").alias("known"),
        "sparse",
        "firmware",
        F.when(F.col("event_id") % 997 == 5, F.col("reading")).alias("rare"),
    )
    return ranking.carry_forward(rows, ["date", "event_id"], ["sparse", "firmware", "rare"])


@query(
    _CYCLES
    + f"""SELECT {_ROW}, {", ".join(
        f"lag({c}, {k}) OVER w AS {c}_lag_{k}" for c in views.FEATURES for k in (1, 2, 3)
    )} FROM cyc WINDOW w AS (PARTITION BY user_id, device_model, cycle_seq ORDER BY date)"""
)
def win6_lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.lag_features(views.cycle_days(spark, sf_dir), SPEC)


@query(
    "WITH "
    + views.SHIPMENT_DAYS_SQL
    + f""",
g AS (SELECT *, CAST(l_shipdate - lag(l_shipdate) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate)
             AS INTEGER) AS gap FROM shipment_days),
c AS (SELECT *, CAST(sum(CASE WHEN gap IS NULL OR gap > 7 THEN 1 ELSE 0 END)
        OVER (PARTITION BY l_suppkey ORDER BY l_shipdate ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS BIGINT) AS cycle_seq FROM g)
SELECT l_suppkey, l_shipdate, failure, quantity, price, discount, tax, cycle_seq, {", ".join(
        f"lag({c}, {k}) OVER w AS {c}_lag_{k}" for c in ("quantity", "price", "discount", "tax") for k in (1, 2)
    )} FROM c WINDOW w AS (PARTITION BY l_suppkey, cycle_seq ORDER BY l_shipdate)"""
)
def win6_lag_features_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cycles.with_cycles(views.shipment_days(spark, sf_dir), views.SHIPMENTS)
    return cycles.lag_features(rows.drop("cycle_start"), views.SHIPMENTS, num_lags=2)


@query(_CYCLES + f"SELECT {_ROW} FROM failed")
def win7_failed_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.keep_failed_cycles(views.cycle_days(spark, sf_dir), SPEC)


@query(_LAGS + f"SELECT {_ROW}, {_LAG_COLS} FROM training")
def win_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates, cycles, failed cycles, lags and null drop in one plan."""
    return views.training(spark, sf_dir)


@query(
    _CYCLES
    + """, firsts AS (
  SELECT user_id, device_model, min(date) AS date, gap_days FROM (
    SELECT user_id, device_model, date, coalesce(gap_days, 1) AS gap_days FROM gaps)
  GROUP BY user_id, device_model, gap_days)
SELECT g.user_id, g.device_model, g.date, coalesce(g.gap_days, 1) AS gap_days, f.date AS first_date
FROM gaps g LEFT JOIN firsts f
  ON g.user_id = f.user_id AND g.device_model = f.device_model AND g.date = f.date
     AND coalesce(g.gap_days, 1) = f.gap_days"""
)
def jon1_attach_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = cycles.day_gaps(_days(spark, sf_dir), SPEC).na.fill(1, ["gap_days"])
    starts = dedup.first_row_per_gap(gaps, SPEC).withColumn("first_date", F.col("date"))
    return joins.attach_cycle_starts(gaps, starts, SPEC)


@query(_CYCLES + f"SELECT {_KEY}, cycle_seq, cycle_start, failure FROM cyc")
def jon2_attach_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.attach_target(_cycle_rows(spark, sf_dir), views.days(spark, sf_dir), SPEC)


@query(_CYCLES + f"SELECT {_KEY}, cycle_seq, cycle_start FROM failed")
def jon3_rows_of_failed_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By semi-join, with the raw readings as the table of failures."""
    return joins.rows_of_failed_cycles(_cycle_rows(spark, sf_dir), views.readings(spark, sf_dir), SPEC)


@query(_CYCLES + f"SELECT {_ROW} FROM failed")
def jon4_telemetry_of_failed_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = joins.rows_of_failed_cycles(_cycle_rows(spark, sf_dir), views.readings(spark, sf_dir), SPEC)
    return joins.with_cycle_columns(views.slim_days(spark, sf_dir), failed, SPEC)


@query(
    _CYCLES
    + f"""SELECT {_KEY}, failure, reading, hour,
  CASE WHEN cycle_failed THEN cycle_seq END AS cycle_seq,
  CASE WHEN cycle_failed THEN cycle_start END AS cycle_start FROM flagged"""
)
def jon5_telemetry_with_failed_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = joins.rows_of_failed_cycles(_cycle_rows(spark, sf_dir), views.readings(spark, sf_dir), SPEC)
    return joins.with_cycle_columns(views.slim_days(spark, sf_dir), failed, SPEC, "left")


def _staged(rows: DataFrame, parts: int = 8, placed: bool = False) -> DataFrame:
    """Rows as a stage table that is laid out by device."""
    hashed = SPEC.hashed()
    folder = scratch_path(rows.sparkSession, "stage")
    commit_table(rows, folder, buckets=Buckets((DEVICE_HASH,), parts, tuple(hashed.day_key)), placed=placed)
    return read_current(rows.sparkSession, folder)


@query(
    _CYCLES
    + f"""SELECT {_KEY}, failure, reading, hour,
  CASE WHEN cycle_failed THEN cycle_seq END AS cycle_seq,
  CASE WHEN cycle_failed THEN cycle_start END AS cycle_start FROM flagged"""
)
def jon5_over_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides are stage tables laid out by device, so the joins shuffle nothing."""
    hashed = SPEC.hashed()
    days = _staged(SPEC.with_device_hash(views.slim_days(spark, sf_dir)))
    cycle_rows = _staged(cycles.cycle_rows(days.select(*hashed.day_key), hashed, unique_days=True), placed=True)
    failed = joins.rows_of_failed_cycles(cycle_rows, days, hashed)
    return joins.with_cycle_columns(days, failed, hashed, "left").drop(DEVICE_HASH)


@query(_LAGS + f"SELECT {_ROW}, {_LAG_COLS} FROM training")
def win_training_rows_over_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cycles, failed cycles and lags over a stage table laid out by device: no shuffle."""
    hashed = SPEC.hashed()
    rows = cycles.with_cycles(_staged(SPEC.with_device_hash(views.slim_days(spark, sf_dir))), hashed)
    failed = cycles.keep_failed_cycles(rows, hashed)
    return cycles.lag_features(failed, hashed).na.drop("any").drop(DEVICE_HASH)


@query(
    _CYCLES
    + f"""SELECT {_ROW}, CASE WHEN bucket < 800 THEN 'train' WHEN bucket < 900 THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, ((user_id % 1000003) * 7919 + cycle_seq * 104729) % 1000 AS bucket FROM cyc)"""
)
def jon6_rows_of_each_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three lists of cycles, and the rows of each by semi-join."""
    rows = views.cycle_days(spark, sf_dir)
    cycle_list = splitting.with_split(rows.where("date = cycle_start"), SPEC, bucket=bucket())
    parts = [
        joins.members(rows, cycle_list.where(F.col("split") == s).select(*SPEC.cycle_key), SPEC.cycle_key)
        .withColumn("split", F.lit(s))
        for s in splitting.Splits._fields
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(_CYCLES + f"SELECT {_KEY}, reading, hour, cycle_seq, cycle_start FROM cyc")
def jon7_new_rows_with_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    new_rows = views.slim_days(spark, sf_dir).drop("failure")
    return joins.with_cycle_columns(new_rows, cycles.cycle_rows(new_rows, SPEC, unique_days=True), SPEC)


@query(_DAYS + f"SELECT {_KEY}, failure, reading, hour FROM days ORDER BY {_KEY}")
def srt1_device_day_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.sort_rows(views.slim_days(spark, sf_dir), SPEC.day_key)


@query(
    _CYCLES
    + """SELECT user_id, device_model, cycle_seq, count(*) AS rows FROM cyc GROUP BY ALL
ORDER BY user_id, device_model, cycle_seq"""
)
def srt2_cycle_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = profiling.value_counts(_cycle_rows(spark, sf_dir), SPEC.cycle_key)
    return ranking.sort_rows(counts, SPEC.cycle_key)


@query(_DAYS + f"SELECT {_KEY}, failure, reading, hour FROM days ORDER BY {_KEY} LIMIT 100")
def lim1_first_hundred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.first_rows(views.slim_days(spark, sf_dir), SPEC.day_key, 100)


@query(_DAYS + "SELECT count(*) AS rows, count(*) AS known FROM (SELECT * FROM days LIMIT 10)")
def lim2_any_ten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any ten rows: which ones is not defined, but all are rows of the table."""
    days = views.slim_days(spark, sf_dir)
    some = ranking.any_rows(days, 10)
    found = some.join(days.select(*SPEC.day_key, F.lit(1).alias("known")), SPEC.day_key, "left")
    return found.agg(F.count("*").alias("rows"), F.count("known").alias("known"))


@query(
    _READINGS
    + """SELECT user_id, device_model, count(*) AS rows FROM readings GROUP BY ALL
ORDER BY rows DESC, user_id, device_model LIMIT 10"""
)
def lim3_top_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = profiling.rows_per_device(views.readings(spark, sf_dir), SPEC)
    return ranking.top_by_count(counts, "rows", SPEC.ids, 10)


@query(
    """SELECT l_partkey, l_suppkey, count(*) AS rows FROM lineitem GROUP BY ALL
ORDER BY rows DESC, l_partkey, l_suppkey LIMIT 10"""
)
def lim3_top_pairs_by_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many values: most of them cannot be among the first, as bounds of their counts tell."""
    return profiling.top_counts(views.table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], 10)


@query(
    _READINGS
    + """SELECT user_id, device_model, count(*) AS rows FROM readings GROUP BY ALL
ORDER BY rows DESC, user_id, device_model LIMIT 10"""
)
def lim3_top_devices_by_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.top_counts(views.readings(spark, sf_dir), SPEC.ids, 10)

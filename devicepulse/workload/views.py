"""The driver's tables as telemetry, once as DataFrames and once as SQL.

`events` is the stand-in for daily device readings: a device is (user, model), a day is the date
of `ts`, a failure is an error event with a value over 40. Markers, infinities, gaps in the data
and constant columns are made from the row's own values, the same way in both forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devicepulse.operators import cycles, dedup
from devicepulse.spec import TelemetrySpec

SPEC = TelemetrySpec(id_cols=("user_id", "device_model"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hundredths(name: str) -> Column:
    """A non-negative number of two decimals as a whole number. `round` would go through decimals."""
    return F.floor(F.col(name) * 100 + 0.5)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw telemetry: several rows per device-day, markers in place."""
    k = F.regexp_extract("props", r"([0-9]+)", 1)
    cents = _hundredths("value")
    slot = F.col("event_id") % 50
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.concat(F.lit("m"), (F.col("user_id") % 7).cast("string")).alias("device_model"),
        F.col("ts").cast("date").alias("date"),
        F.when((F.col("event_type") == "error") & (F.col("value") > 40), 1)
        .otherwise(0)
        .alias("failure"),
        "event_id",
        cents.alias("reading"),
        F.hour("ts").alias("hour"),
        F.when(F.col("event_id") % 10 == 0, "NA")
        .when(F.col("event_id") % 10 == 1, "nan")
        .otherwise(k)
        .alias("k_text"),
        F.when(slot == 0, float("nan"))
        .when(slot == 1, float("inf"))
        .when(slot == 2, float("-inf"))
        .otherwise(F.col("value"))
        .alias("ratio"),
        F.when(F.col("event_id") % 2 == 0, cents).alias("sparse"),
        F.when(F.col("event_id") % 5 != 0, cents).alias("partial"),
        F.lit(1).alias("fleet"),
        F.when(F.col("event_id") % 3 == 0, "v1").alias("firmware"),
    )


READINGS_SQL = """
readings AS (
  SELECT user_id,
         'm' || CAST(user_id % 7 AS VARCHAR) AS device_model,
         CAST(ts AS DATE) AS date,
         CASE WHEN event_type = 'error' AND value > 40 THEN 1 ELSE 0 END AS failure,
         event_id,
         CAST(round(value * 100) AS BIGINT) AS reading,
         CAST(hour(ts) AS INTEGER) AS hour,
         CASE event_id % 10 WHEN 0 THEN 'NA' WHEN 1 THEN 'nan'
              ELSE regexp_extract(props, '([0-9]+)', 1) END AS k_text,
         CASE event_id % 50 WHEN 0 THEN CAST('NaN' AS DOUBLE)
              WHEN 1 THEN CAST('Infinity' AS DOUBLE)
              WHEN 2 THEN CAST('-Infinity' AS DOUBLE) ELSE value END AS ratio,
         CASE WHEN event_id % 2 = 0 THEN CAST(round(value * 100) AS BIGINT) END AS sparse,
         CASE WHEN event_id % 5 <> 0 THEN CAST(round(value * 100) AS BIGINT) END AS partial,
         1 AS fleet,
         CASE WHEN event_id % 3 = 0 THEN 'v1' END AS firmware
  FROM events)"""


# NaN and infinities do not compare alike everywhere: the finite value, and next to it what else it is.
RATIO_SQL = """CASE WHEN NOT isnan(ratio) AND NOT isinf(ratio) THEN ratio END AS ratio,
  CASE WHEN isnan(ratio) THEN 'nan' WHEN isinf(ratio) AND ratio > 0 THEN 'inf'
       WHEN isinf(ratio) THEN '-inf' END AS ratio_is"""


def told_ratio(df: DataFrame) -> DataFrame:
    """`ratio` as its finite value, with `ratio_is` beside it."""
    nan, endless = F.isnan("ratio"), F.abs("ratio") == float("inf")
    kind = F.when(nan, "nan").when(endless & (F.col("ratio") > 0), "inf").when(endless, "-inf")
    return df.withColumn("ratio_is", kind).withColumn("ratio", F.when(~nan & ~endless, F.col("ratio")))


def day_order() -> list:
    """Which row of a device-day stays: a failing one first, then the earliest."""
    return [F.col("failure").desc(), F.col("event_id")]


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per device-day."""
    return dedup.one_row_per_day(readings(spark, sf_dir), SPEC, day_order())


DAYS_SQL = (
    READINGS_SQL
    + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, device_model, date
                               ORDER BY failure DESC, event_id) AS place
  FROM readings),
days AS (SELECT * EXCLUDE (place) FROM placed WHERE place = 1)"""
)

FEATURES = ["reading", "hour"]


def slim_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device-days with two complete features."""
    return days(spark, sf_dir).select(*SPEC.day_key, SPEC.target_col, *FEATURES)


def cycle_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device-days with two features and their cycle."""
    return cycles.with_cycles(slim_days(spark, sf_dir), SPEC)


CYCLES_SQL = (
    DAYS_SQL
    + """,
gaps AS (
  SELECT user_id, device_model, date, failure, reading, hour,
         CAST(date - lag(date) OVER device AS INTEGER) AS gap_days
  FROM days WINDOW device AS (PARTITION BY user_id, device_model ORDER BY date)),
cyc AS (
  SELECT user_id, device_model, date, failure, reading, hour,
         CAST(sum(CASE WHEN gap_days IS NULL OR gap_days > 1 THEN 1 ELSE 0 END) OVER device
              AS BIGINT) AS cycle_seq,
         max(CASE WHEN gap_days IS NULL OR gap_days > 1 THEN date END) OVER device AS cycle_start
  FROM gaps WINDOW device AS (PARTITION BY user_id, device_model ORDER BY date
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
flagged AS (
  SELECT *, max(failure) OVER (PARTITION BY user_id, device_model, cycle_seq) = 1 AS cycle_failed
  FROM cyc),
failed AS (SELECT * EXCLUDE (cycle_failed) FROM flagged WHERE cycle_failed)"""
)

LAGS_SQL = (
    CYCLES_SQL
    + """,
lagged AS (
  SELECT *,
         lag(reading, 1) OVER w AS reading_lag_1, lag(reading, 2) OVER w AS reading_lag_2,
         lag(reading, 3) OVER w AS reading_lag_3,
         lag(hour, 1) OVER w AS hour_lag_1, lag(hour, 2) OVER w AS hour_lag_2,
         lag(hour, 3) OVER w AS hour_lag_3
  FROM failed WINDOW w AS (PARTITION BY user_id, device_model, cycle_seq ORDER BY date)),
training AS (SELECT * FROM lagged WHERE reading_lag_3 IS NOT NULL)"""
)


def training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lagged rows of failed cycles, without nulls: the flagship chain. Two shuffles, one by
    device-day for the duplicates and one by device for all the rest."""
    failed = cycles.keep_failed_cycles(cycle_days(spark, sf_dir), SPEC)
    return cycles.lag_features(failed, SPEC).na.drop("any")


# Shipments of a supplier as a second telemetry table, with four features.
SHIPMENTS = TelemetrySpec(id_cols=("l_suppkey",), date_col="l_shipdate", gap_days=7)


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.col("l_shipdate").cast("date").alias("l_shipdate"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("failure"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").cast("bigint").alias("quantity"),
        _hundredths("l_extendedprice").alias("price"),
        _hundredths("l_discount").alias("discount"),
        _hundredths("l_tax").alias("tax"),
    )


def shipment_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.one_row_per_day(shipments(spark, sf_dir), SHIPMENTS).drop(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


SHIPMENT_DAYS_SQL = """
shipments AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS l_shipdate,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS failure,
         l_orderkey, l_linenumber, l_partkey,
         CAST(l_quantity AS BIGINT) AS quantity,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS price,
         CAST(round(l_discount * 100) AS BIGINT) AS discount,
         CAST(round(l_tax * 100) AS BIGINT) AS tax
  FROM lineitem),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_shipdate
                               ORDER BY failure DESC, l_orderkey, l_linenumber, l_partkey,
                                        quantity, price, discount, tax) AS place
  FROM shipments),
shipment_days AS (
  SELECT l_suppkey, l_shipdate, failure, quantity, price, discount, tax
  FROM placed WHERE place = 1)"""

"""Aggregations, profiles and duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicepulse.functions import SENTINELS
from devicepulse.operators import cleaning, cycles, dedup, profiling, ranking, states
from devicepulse.sources import scratch_path
from devicepulse.workload import views
from devicepulse.workload.registry import query
from devicepulse.workload.views import SPEC

_READINGS = f"WITH {views.READINGS_SQL} "
_DAYS = f"WITH {views.DAYS_SQL} "
_CYCLES = f"WITH {views.CYCLES_SQL} "
_SHIPMENTS = f"WITH {views.SHIPMENT_DAYS_SQL} "
_MISSING = {
    "user_id": "user_id IS NULL",
    "device_model": "device_model IS NULL",
    "date": "date IS NULL",
    "failure": "failure IS NULL",
    "event_id": "event_id IS NULL",
    "reading": "reading IS NULL",
    "hour": "hour IS NULL",
    "k_text": f"k_text IN {SENTINELS}",
    "ratio": "isnan(ratio) OR isinf(ratio)",
    "sparse": "sparse IS NULL",
    "partial": "partial IS NULL",
    "fleet": "fleet IS NULL",
    "firmware": "firmware IS NULL",
}


def _lines(select: str, columns, source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, {select.format(c=c)} FROM {source}" for c in columns)


@query("SELECT count(*) AS rows FROM events")
def agg1_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.row_count(views.table(spark, sf_dir, "events"))


@query(
    _READINGS
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE {test}) AS null_count,
        round(CAST(count(*) FILTER (WHERE {test}) AS DOUBLE) / count(*), 9) AS null_fraction FROM readings"""
        for c, test in _MISSING.items()
    )
)
def agg2_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = profiling.null_profile(cleaning.parse_sentinels(views.readings(spark, sf_dir)))
    return profile.withColumn("null_fraction", F.round("null_fraction", 9))


_COUNTED = [
    "user_id", "device_model", "date", "failure", "event_id", "reading", "hour", "k_text", "ratio",
    "sparse", "partial", "fleet", "firmware",
]


@query(_READINGS + _lines("count(DISTINCT {c}) AS distinct_count", _COUNTED, "readings"))
def agg3_distinct_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.distinct_profile(views.readings(spark, sf_dir).select(*_COUNTED))


@query(_READINGS + _lines("count(DISTINCT {c}) AS exact, TRUE AS sketch_is_close", _COUNTED, "readings"))
def agg3_distinct_profile_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketch next to the exact count, from which it may differ by five standard errors."""
    rows = views.readings(spark, sf_dir).select(*_COUNTED)
    exact = profiling.distinct_profile(rows).withColumnRenamed("distinct_count", "exact")
    both = exact.join(profiling.distinct_profile(rows, approximate=True, rsd=0.02), "column_name")
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= 0.1 * F.col("exact")
    return both.select("column_name", "exact", close.alias("sketch_is_close"))


@query(_READINGS + _lines("count(DISTINCT {c}) < 2 AS is_constant", _COUNTED, "readings"))
def agg4_constant_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.constant_profile(views.readings(spark, sf_dir).select(*_COUNTED))


_STATE_SQL = _READINGS + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS null_count,
  round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 9) AS null_fraction,
  count(DISTINCT {c}) < 2 AS is_constant, count(DISTINCT {c}) AS distinct_count FROM readings"""
    for c in _COUNTED
)


@query(_STATE_SQL)
def agg2_profile_of_merged_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, constants and distinct values from stored states of days, delivered in two parts, the second of
    which brings a day of the first once more."""
    rows = views.readings(spark, sf_dir).select(*_COUNTED)
    counts, values = scratch_path(spark, "states"), scratch_path(spark, "values")
    parts = F.pmod(F.datediff("date", F.lit("2024-01-01")), F.lit(4))
    for part in (parts < 3, parts >= 2):
        states.save_days(states.day_states(rows.where(part), "date"), counts, "date")
        states.save_days(states.day_values(rows.where(part), "date"), values, "date")
    profile = states.merged_profile(spark.read.parquet(counts), spark.read.parquet(values))
    return profile.withColumn("null_fraction", F.round("null_fraction", 9))


@query(_READINGS + "SELECT min(date) AS first_date, max(date) AS last_date FROM readings")
def agg5_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.date_range(views.readings(spark, sf_dir), SPEC)


@query("SELECT count(DISTINCT user_id) AS distinct_count FROM events")
def agg6_distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.distinct_count(views.table(spark, sf_dir, "events"), ["user_id"])


@query(
    _READINGS
    + "SELECT count(DISTINCT (user_id, device_model)) AS distinct_count FROM readings WHERE failure = 1"
)
def agg7_failing_device_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.failing_device_count(views.readings(spark, sf_dir), SPEC)


@query(_READINGS + "SELECT failure, count(*) AS rows FROM readings GROUP BY failure")
def agg8_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.class_counts(views.readings(spark, sf_dir), SPEC)


@query(
    _READINGS
    + """SELECT failure, count(*) AS rows,
  round(CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM readings), 6) AS percent
FROM readings GROUP BY failure"""
)
def agg9_class_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = profiling.class_shares(views.readings(spark, sf_dir), SPEC)
    return shares.withColumn("percent", F.round(F.col("percent").cast("double"), 6))


@query(_READINGS + "SELECT hour, count(*) AS rows FROM readings GROUP BY hour")
def agg10_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.value_counts(views.readings(spark, sf_dir), ["hour"])


@query(_READINGS + "SELECT user_id, device_model, count(*) AS rows FROM readings GROUP BY ALL ORDER BY rows DESC, user_id")
def agg11_rows_per_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = profiling.rows_per_device(views.readings(spark, sf_dir), SPEC)
    return ranking.sort_rows(counts, [F.col("rows").desc(), *SPEC.ids])


@query(
    _READINGS
    + """SELECT device_model, count(DISTINCT user_id) AS devices FROM readings WHERE failure = 1
GROUP BY device_model ORDER BY devices DESC, device_model"""
)
def agg12_failing_devices_per_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = profiling.failing_devices_by(views.readings(spark, sf_dir), SPEC, ["device_model"])
    return ranking.sort_rows(counts, [F.col("devices").desc(), "device_model"])


@query(
    _READINGS
    + """SELECT user_id, count(DISTINCT device_model) AS devices FROM readings WHERE failure = 1
GROUP BY user_id"""
)
def agg12_failing_devices_per_serial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.failing_devices_by(views.readings(spark, sf_dir), SPEC, ["user_id"])


@query(
    _CYCLES
    + """SELECT user_id, device_model, count(DISTINCT gap_days) AS gap_lengths FROM gaps
WHERE gap_days IS NOT NULL GROUP BY user_id, device_model"""
)
def agg13_gap_variety(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = cycles.device_days(views.readings(spark, sf_dir), SPEC)
    return profiling.gap_variety(cycles.day_gaps(days, SPEC), SPEC)


@query(
    _SHIPMENTS
    + """SELECT failure, round(avg(quantity), 6) AS quantity, round(avg(price), 6) AS price,
  round(avg(discount), 6) AS discount, round(avg(tax), 6) AS tax FROM shipment_days GROUP BY failure"""
)
def agg14_class_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = profiling.class_means(views.shipment_days(spark, sf_dir), views.SHIPMENTS)
    return means.select("failure", *[F.round(c, 6).alias(c) for c in means.columns if c != "failure"])


_MEASURED = ["quantity", "price", "discount", "tax"]
_MOMENTS_SQL = (
    "count({c}) AS rows, round(avg(CAST({c} AS DOUBLE)), 4) AS mean, "
    "round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
    "CAST(max({c}) AS DOUBLE) AS max"
)


def _rounded(profile: DataFrame, columns: list[str]) -> DataFrame:
    return profile.withColumns({c: F.round(c, 4) for c in columns})


@query(_SHIPMENTS + _lines(_MOMENTS_SQL, _MEASURED, "shipments"))
def agg15_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = profiling.describe(views.shipments(spark, sf_dir), _MEASURED)
    return _rounded(profile, ["mean", "stddev"])


@query(
    _SHIPMENTS
    + _lines(
        _MOMENTS_SQL
        + "".join(
            f", round(quantile_cont(CAST({{c}} AS DOUBLE), {p}), 4) AS {k}"
            for k, p in {"q25": 0.25, "q50": 0.5, "q75": 0.75}.items()
        ),
        _MEASURED,
        "shipments",
    )
)
def agg16_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With exact quartiles; the sketch is the default."""
    profile = profiling.summary(views.shipments(spark, sf_dir), _MEASURED, exact=True)
    return _rounded(profile, ["mean", "stddev", "q25", "q50", "q75"])


@query(
    _SHIPMENTS
    + _lines(_MOMENTS_SQL + ", TRUE AS q25_close, TRUE AS q50_close, TRUE AS q75_close", _MEASURED, "shipments")
)
def agg16_summary_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass with sketched quartiles, each within two percent of the ranks around the exact one."""
    rows = views.shipments(spark, sf_dir)
    around = ranking.exact_quantiles(rows, _MEASURED, [0.23, 0.27, 0.48, 0.52, 0.73, 0.77])
    bounds = around.groupBy("column_name").agg(
        *[
            F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(f"_{p}")
            for p in (0.23, 0.27, 0.48, 0.52, 0.73, 0.77)
        ]
    )
    profile = profiling.summary(rows, _MEASURED).join(bounds, "column_name")
    return _rounded(profile, ["mean", "stddev"]).select(
        "column_name", "rows", "mean", "stddev", "min", "max",
        F.col("q25").between(F.col("`_0.23`"), F.col("`_0.27`")).alias("q25_close"),
        F.col("q50").between(F.col("`_0.48`"), F.col("`_0.52`")).alias("q50_close"),
        F.col("q75").between(F.col("`_0.73`"), F.col("`_0.77`")).alias("q75_close"),
    )


@query(_READINGS + "SELECT DISTINCT device_model FROM readings")
def agg17_distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.distinct_values(views.readings(spark, sf_dir), ["device_model"])


@query(_DAYS + "SELECT user_id, device_model, date, failure, event_id, reading, hour FROM days")
def ded1_one_row_per_device_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.days(spark, sf_dir).select(*SPEC.day_key, "failure", "event_id", "reading", "hour")


@query(_SHIPMENTS + "SELECT * FROM shipment_days")
def ded1_default_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No order given: highest target, then all other columns."""
    return views.shipment_days(spark, sf_dir)


@query("""
SELECT l_partkey, l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey, l_shipdate
    ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS place FROM lineitem)
WHERE place = 1
""")
def ded1_mostly_unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few repeats: only their rows are compared."""
    key = ["l_partkey", "l_suppkey", "l_shipdate"]
    payload = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    lines = views.table(spark, sf_dir, "lineitem").select(*key, *payload)
    return dedup.one_row_per_mostly_unique_key(lines, key, payload)


@query("SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS date FROM events")
def ded2_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    return dedup.distinct_rows(events.select("user_id", "event_type", F.col("ts").cast("date").alias("date")))


@query(
    _CYCLES
    + """SELECT user_id, device_model, min(date) AS date, gap_days FROM (
  SELECT user_id, device_model, date, coalesce(gap_days, 1) AS gap_days FROM gaps)
GROUP BY user_id, device_model, gap_days"""
)
def ded3_first_of_each_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = cycles.device_days(views.readings(spark, sf_dir), SPEC)
    return dedup.first_row_per_gap(cycles.day_gaps(days, SPEC), SPEC)

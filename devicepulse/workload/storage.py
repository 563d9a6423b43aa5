"""Sources and sinks: each query writes a table derived from the given ones and reads it back."""

from __future__ import annotations

import contextlib

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicepulse.operators import cleaning, model, profiling, ranking, scaling, splitting
from devicepulse.sources import (
    commit_table,
    current_version,
    load_manifest,
    load_scaler,
    read_current,
    read_table,
    save_artefact,
    save_manifest,
    scratch_path,
    without_target,
    write_scores,
    write_table,
)
from devicepulse.workload import views
from devicepulse.workload.registry import query
from devicepulse.workload.views import SPEC

COLUMNS = [
    "user_id", "device_model", "date", "failure", "event_id", "reading", "hour", "k_text", "ratio",
    "sparse", "partial", "fleet", "firmware",
]
ROWS_SQL = f"""WITH {views.READINGS_SQL} SELECT {', '.join(c for c in COLUMNS if c != 'ratio')}, {views.RATIO_SQL}
FROM readings"""
DAY_COLUMNS = [*SPEC.day_key, "failure", "reading", "hour"]
DAY_ROWS_SQL = f"WITH {views.DAYS_SQL} SELECT {', '.join(DAY_COLUMNS)} FROM days"


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.readings(spark, sf_dir).select(*COLUMNS)


@query(ROWS_SQL)
def src1_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with header, types inferred. Inference picks the narrowest type, so widen the numbers."""
    path = scratch_path(spark, "readings")
    rows = _rows(spark, sf_dir)
    write_table(rows, path, "csv")
    inferred = read_table(spark, path, "csv")
    return views.told_ratio(inferred.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema.fields]))


@query(ROWS_SQL)
def src2_csv_parts_with_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of CSV parts, types given."""
    path = scratch_path(spark, "readings")
    rows = _rows(spark, sf_dir)
    write_table(rows, path, "csv")
    return views.told_ratio(read_table(spark, path, "csv", schema=rows.schema))


@query("SELECT user_id, event_type, value FROM events")
def src3_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/events.parquet", columns=["user_id", "event_type", "value"])


@query("""
SELECT * FROM (
  SELECT 'event_id' AS column_name, CAST(0 AS INTEGER) AS position, 'bigint' AS data_type,
         count(*) AS rows, count(event_id) AS non_null FROM events
  UNION ALL SELECT 'ts', 1, 'timestamp_ntz', count(*), count(ts) FROM events
  UNION ALL SELECT 'user_id', 2, 'bigint', count(*), count(user_id) FROM events
  UNION ALL SELECT 'event_type', 3, 'string', count(*), count(event_type) FROM events
  UNION ALL SELECT 'value', 4, 'double', count(*), count(value) FROM events
  UNION ALL SELECT 'props', 5, 'string', count(*), count(props) FROM events)
""")
def src4_schema_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.schema_profile(views.table(spark, sf_dir, "events"))


@query(ROWS_SQL)
def snk1_csv_fail_if_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "readings")
    rows = _rows(spark, sf_dir)
    write_table(rows, path, "csv", mode="errorifexists")
    return views.told_ratio(read_table(spark, path, "csv", schema=rows.schema))


@query(ROWS_SQL)
def snk2_csv_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice to one place: the second write replaces the first, which had other rows."""
    path = scratch_path(spark, "readings")
    rows = _rows(spark, sf_dir)
    write_table(rows.withColumn("failure", 1 - F.col("failure")).union(rows), path, "csv", mode="overwrite")
    write_table(rows, path, "csv", mode="overwrite")
    return views.told_ratio(read_table(spark, path, "csv", schema=rows.schema))


@query(DAY_ROWS_SQL.replace("SELECT user_id", "SELECT 2 AS version, user_id"))
def snk2_overwrite_by_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is overwritten, then once more by a write that stops halfway: readers stay at the second."""
    folder = scratch_path(spark, "days")
    rows = views.days(spark, sf_dir).select(*DAY_COLUMNS)
    commit_table(rows.where("hour < 12"), folder)
    commit_table(rows, folder, mode="overwrite")
    stops = F.when(F.col("user_id") < 0, 0).otherwise(F.raise_error(F.lit("the write stops here")))
    with contextlib.suppress(PySparkException):
        commit_table(rows.withColumn("reading", stops), folder, mode="overwrite")
    return read_current(spark, folder).withColumn("version", F.lit(current_version(spark, folder).number))


@query(DAY_ROWS_SQL)
def snk3_sorted_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table in key order, in parts that executors write."""
    path = scratch_path(spark, "days")
    write_table(ranking.sort_rows(views.slim_days(spark, sf_dir), SPEC.day_key), path)
    return read_table(spark, path)


@query(DAY_ROWS_SQL)
def snk4_manifest_typed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved names and types read the CSV back without inference."""
    path, columns = scratch_path(spark, "days"), scratch_path(spark, "days_columns")
    rows = views.slim_days(spark, sf_dir)
    write_table(rows, path, "csv")
    save_manifest(rows, columns)
    return read_table(spark, path, "csv", schema=load_manifest(spark, columns))


@query(
    f"WITH {views.DAYS_SQL} SELECT user_id, device_model, date, reading, hour FROM days"
)
def src5_manifest_without_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows laid out by the saved manifest, which loses its target."""
    columns = scratch_path(spark, "days_columns")
    save_manifest(views.slim_days(spark, sf_dir), columns)
    layout = without_target(load_manifest(spark, columns), SPEC.target_col)
    return cleaning.select_as(views.days(spark, sf_dir), layout)


GUESS_SQL = f"""
WITH {views.CYCLES_SQL},
guessed AS (
  SELECT CASE WHEN bucket < 800 THEN 'train' WHEN bucket < 900 THEN 'val' ELSE 'test' END AS split,
         failure, CASE WHEN reading > 6000 THEN 1 ELSE 0 END AS prediction
  FROM (SELECT *, ((user_id % 1000003) * 7919 + cycle_seq * 104729) % 1000 AS bucket FROM cyc)),
cells AS (SELECT split, failure AS label, prediction, count(*) AS n FROM guessed GROUP BY ALL),
sides AS (
  SELECT split, label AS class, n AS actual, 0 AS guessed,
         CASE WHEN label = prediction THEN n ELSE 0 END AS hits FROM cells
  UNION ALL SELECT split, prediction, 0, n, 0 FROM cells),
classes AS (
  SELECT split, class, CAST(sum(actual) AS DOUBLE) AS actual, CAST(sum(guessed) AS DOUBLE) AS guessed,
         CAST(sum(hits) AS DOUBLE) AS hits FROM sides GROUP BY split, class),
scores AS (
  SELECT split, sum(2 * hits / (actual + guessed) * actual) / sum(actual) AS f1
  FROM classes GROUP BY split)
"""


def bucket():
    """An integer bucket that SQL can compute as well."""
    return F.expr("((user_id % 1000003) * 7919 + cycle_seq * 104729) % 1000")


def guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device-days with a rule's guess in place of a model's."""
    rows = splitting.with_split(views.cycle_days(spark, sf_dir), SPEC, bucket=bucket())
    return rows.withColumn("prediction", F.when(F.col("reading") > 6000, 1.0).otherwise(0.0))


def guess_splits(spark: SparkSession, sf_dir: str) -> splitting.Splits:
    rows = guesses(spark, sf_dir)
    return splitting.Splits(*[rows.where(F.col("split") == s) for s in splitting.Splits._fields])


@query(
    GUESS_SQL
    + """
SELECT 'f1' AS "metricName",
       round(max(CASE WHEN split = 'train' THEN f1 END), 9) AS train,
       round(max(CASE WHEN split = 'val' THEN f1 END), 9) AS val,
       round(max(CASE WHEN split = 'test' THEN f1 END), 9) AS test FROM scores"""
)
def snk5_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "scores")
    scores = model.score_splits(guess_splits(spark, sf_dir), SPEC)
    write_scores(scores, path)
    back = spark.read.schema(scores.schema).json(path)
    return back.select("metricName", *[F.round(c, 9).alias(c) for c in ("train", "val", "test")])


def _scaled_before_and_after(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Device-days scaled by a fitted scaler and by the same one saved and loaded."""
    path = scratch_path(spark, "scaler")
    rows = views.slim_days(spark, sf_dir)
    fitted = scaling.fit_scaler(rows, views.FEATURES)
    save_artefact(fitted, path)
    before, after = (
        scaling.scale_features(rows, s, views.FEATURES, SPEC.day_key) for s in (fitted, load_scaler(path))
    )
    return before, after


@query(f"WITH {views.DAYS_SQL} SELECT count(*) AS rows, count(*) AS equal_rows FROM days")
def snk6_saved_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was saved scales every row as what was fitted."""
    before, after = _scaled_before_and_after(spark, sf_dir)
    renamed = after.withColumnsRenamed({c: f"{c}_after" for c in views.FEATURES})
    same = F.lit(True)
    for c in views.FEATURES:
        same = same & (F.col(c) == F.col(f"{c}_after"))
    return before.join(renamed, SPEC.day_key).agg(
        F.count("*").alias("rows"), F.count_if(same).alias("equal_rows")
    )


@query(f"WITH {views.DAYS_SQL} SELECT user_id, device_model, date FROM days")
def src6_loaded_scaler_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every device-day comes out of the reloaded scaler, once and with finite features."""
    _, scaled = _scaled_before_and_after(spark, sf_dir)
    return cleaning.drop_incomplete(cleaning.parse_sentinels(scaled)).select(*SPEC.day_key)

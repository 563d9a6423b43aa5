"""Projections, filters and scalar expressions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicepulse.functions import day_gap
from devicepulse.operators import cleaning, cycles, joins, scaling
from devicepulse.spec import non_string_cols
from devicepulse.workload import views
from devicepulse.workload.registry import query
from devicepulse.workload.views import SPEC

_TEXT = "CASE WHEN k_text IN ('NA', 'na', 'NaN', 'nan', 'Infinity', '-Infinity') THEN NULL ELSE k_text END"
_FINITE = "CASE WHEN isnan(ratio) OR isinf(ratio) THEN NULL ELSE ratio END"
_KEYS = "event_id, user_id, device_model, date, failure"
_READINGS = f"WITH {views.READINGS_SQL} "


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.parse_sentinels(views.readings(spark, sf_dir))


def _keyed(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("event_id", *SPEC.ids, "date", "failure", *columns)


_OTHERS = "reading, hour, sparse, partial, fleet, firmware"


@query(_READINGS + f"SELECT {_KEYS}, {_OTHERS}, {_TEXT} AS k_text, {_FINITE} AS ratio FROM readings")
def prj1_null_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir)


@query(
    _READINGS
    + f"""SELECT {_KEYS}, {_OTHERS}, CASE WHEN k_text = 'NA' THEN NULL ELSE k_text END AS k_text,
          {views.RATIO_SQL} FROM readings"""
)
def prj2_null_one_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.told_ratio(cleaning.parse_sentinels(views.readings(spark, sf_dir), ["NA"]))


@query(
    _READINGS
    + f"""SELECT * REPLACE (nullif(ratio_is, 'nan') AS ratio_is) FROM (
          SELECT {_KEYS}, {_OTHERS},
            CASE WHEN k_text IN ('NA', 'na', 'NaN', 'nan') THEN NULL ELSE k_text END AS k_text,
            {views.RATIO_SQL} FROM readings)"""
)
def prj3_null_four_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without an infinity in the list, infinities stay."""
    four = cleaning.parse_sentinels(views.readings(spark, sf_dir), ["NA", "na", "NaN", "nan"])
    return views.told_ratio(four)


@query(_READINGS + f"SELECT {_KEYS}, TRY_CAST({_TEXT} AS DOUBLE) AS k_text FROM readings")
def prj4_restore_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(cleaning.restore_numbers(_parsed(spark, sf_dir), ["k_text"]), "k_text")


@query(
    _READINGS
    + f"""SELECT {_KEYS}, reading, hour, {_TEXT} AS k_text, {_FINITE} AS ratio, partial, fleet FROM readings"""
)
def prj5_drop_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`sparse` is half null and `firmware` two thirds: both go at the 0.4 cutoff."""
    parsed = _parsed(spark, sf_dir)
    return cleaning.drop_columns(parsed, cleaning.sparse_columns(parsed, SPEC))


@query(
    _READINGS + "SELECT date, failure, user_id, device_model, event_id, reading, hour, "
    f"{_FINITE} AS ratio, fleet FROM readings"
)
def prj6_keep_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Protected columns first, then those at most a tenth null."""
    parsed = _parsed(spark, sf_dir)
    return cleaning.select_as(parsed, cleaning.dense_columns(parsed, SPEC, cutoff=0.1))


@query(
    _READINGS
    + f"SELECT {_KEYS}, reading, hour, {_TEXT} AS k_text, {_FINITE} AS ratio, sparse, partial FROM readings"
)
def prj7_drop_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`fleet` is constant, `firmware` is constant where present."""
    parsed = _parsed(spark, sf_dir)
    return cleaning.drop_columns(parsed, cleaning.constant_columns(parsed, SPEC))


@query(_READINGS + f"SELECT {_KEYS}, reading, hour FROM readings")
def prj8_drop_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["k_text", "ratio", "sparse", "partial", "fleet", "firmware"]
    return cleaning.drop_columns(views.readings(spark, sf_dir), names)


@query(_READINGS + "SELECT hour, reading, user_id, device_model, date FROM readings")
def prj9_select_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["hour", "reading", "user_id", "device_model", "date"]
    return cleaning.select_as(views.readings(spark, sf_dir), names)


@query("WITH " + views.SHIPMENT_DAYS_SQL + " SELECT quantity, price, discount, tax FROM shipment_days")
def prj10_feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.shipment_days(spark, sf_dir)
    return rows.select(*views.SHIPMENTS.feature_cols(rows))


@query("SELECT event_id, ts, user_id, value FROM events")
def prj11_non_string_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    return events.select(*non_string_cols(events))


@query(
    f"""WITH {views.DAYS_SQL} SELECT user_id, device_model, date, CAST(reading AS DOUBLE) AS first_value,
        CAST(hour AS DOUBLE) AS second_value FROM days"""
)
def prj12_unpack_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = scaling.assemble(views.slim_days(spark, sf_dir), views.FEATURES, SPEC.day_key)
    return cleaning.unpack_vector(vectors, "features", ["first_value", "second_value"], SPEC.day_key)


@query(_READINGS + f"SELECT {_KEYS}, reading * 2 AS twice, hour + 1 AS next_hour FROM readings")
def prj13_computed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = cleaning.add_columns(
        views.readings(spark, sf_dir),
        {"twice": F.col("reading") * 2, "next_hour": F.col("hour") + 1},
    )
    return _keyed(added, "twice", "next_hour")


@query(_READINGS + f"SELECT {_KEYS}, reading FROM readings WHERE failure = 1")
def flt1_failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(cleaning.rows_with_target(views.readings(spark, sf_dir), SPEC), "reading")


@query(
    _READINGS
    + f"""SELECT {_KEYS}, reading, k_text, ratio, partial FROM (
  SELECT {_KEYS}, reading, {_TEXT} AS k_text, {_FINITE} AS ratio, partial FROM readings)
WHERE k_text IS NOT NULL AND ratio IS NOT NULL AND partial IS NOT NULL"""
)
def flt2_drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_incomplete(_keyed(_parsed(spark, sf_dir), "reading", "k_text", "ratio", "partial"))


@query(
    _READINGS
    + f"""SELECT count(*) AS rows,
  count(*) FILTER (WHERE {_TEXT} IS NOT NULL AND partial IS NOT NULL) AS kept,
  count(*) FILTER (WHERE {_TEXT} IS NULL OR partial IS NULL) AS dropped FROM readings"""
)
def flt2_incomplete_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.completeness(_parsed(spark, sf_dir), ["k_text", "partial"])


@query(_READINGS + f"SELECT {_KEYS}, coalesce(partial, 1) AS partial, sparse FROM readings")
def flt3_fill_one_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(cleaning.fill_missing(views.readings(spark, sf_dir), 1, ["partial"]), "partial", "sparse")


@query(
    f"""WITH {views.CYCLES_SQL}
SELECT user_id, device_model, date, cycle_seq, cycle_start, reading FROM cyc
WHERE (user_id, device_model, cycle_seq) IN
      (SELECT (user_id, device_model, cycle_seq) FROM cyc WHERE failure = 1)"""
)
def flt4_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.cycle_days(spark, sf_dir)
    chosen = rows.where(F.col("failure") == 1).select(*SPEC.cycle_key)
    return joins.members(rows, chosen, SPEC.cycle_key).drop("failure", "hour")


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS INTEGER) AS gap FROM orders")
def scl1_date_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    since = F.lit("1995-01-01").cast("date")
    gap = day_gap(F.col("o_orderdate").cast("date"), since).alias("gap")
    return views.table(spark, sf_dir, "orders").select("o_orderkey", gap)


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'high' ELSE 'low' END AS band FROM orders")
def scl2_case_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    band = F.when(F.col("o_totalprice") > 250000, "high").otherwise("low").alias("band")
    return views.table(spark, sf_dir, "orders").select("o_orderkey", band)


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def scl3_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))


@query(_READINGS + "SELECT event_id, sparse IS NULL AS missing, sparse IS NOT NULL AS present FROM readings")
def scl4_null_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    sparse = F.col("sparse")
    return views.readings(spark, sf_dir).select(
        "event_id", sparse.isNull().alias("missing"), sparse.isNotNull().alias("present")
    )


@query("SELECT l_orderkey, l_linenumber, l_quantity / 4 AS quarter FROM lineitem")
def scl5_divide(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 4).alias("quarter"))


@query("SELECT o_orderkey, 1 AS one, CAST(NULL AS INTEGER) AS missing FROM orders")
def scl6_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", F.lit(1).alias("one"), F.lit(None).cast("int").alias("missing"))


@query("SELECT o_orderkey, o_orderstatus = 'F' AS finished FROM orders")
def scl7_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", (F.col("o_orderstatus") == "F").alias("finished"))


@query("SELECT vec_id, embedding[1] AS first_element, embedding[4] AS fourth_element FROM embeddings")
def scl8_array_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = views.table(spark, sf_dir, "embeddings")
    element = F.col("embedding").getItem
    return vectors.select(
        "vec_id", element(0).alias("first_element"), element(3).alias("fourth_element")
    )


@query(
    """SELECT l_orderkey, l_linenumber, CAST(len(list_value(l_quantity, l_tax)) AS INTEGER) AS width,
       l_quantity AS quantity, l_tax AS tax FROM lineitem"""
)
def scl9_vector_to_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.table(spark, sf_dir, "lineitem")
    vectors = scaling.assemble(lines, ["l_quantity", "l_tax"], ["l_orderkey", "l_linenumber"])
    values = vectors.withColumn("values", vector_to_array("features"))
    return values.select(
        "l_orderkey",
        "l_linenumber",
        F.size("values").alias("width"),
        F.col("values").getItem(0).alias("quantity"),
        F.col("values").getItem(1).alias("tax"),
    )


@query("SELECT o_custkey AS device, CAST(o_orderdate AS DATE) AS date FROM orders")
def scl10_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders")
    return orders.select(F.col("o_custkey").alias("device"), F.col("o_orderdate").cast("date").alias("date"))


@query(
    f"""WITH {views.DAYS_SQL} SELECT user_id, device_model, date,
  last_value(partial IGNORE NULLS) OVER (PARTITION BY user_id, device_model ORDER BY date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS partial FROM days"""
)
def win5_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.days(spark, sf_dir).select(*SPEC.day_key, "partial")
    return cycles.forward_fill(rows, ["partial"], SPEC)

"""A third of all rows on one device, half of those on one day."""

import duckdb
import pytest
from parity import differences
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from devicepulse.operators import cycles, dedup, joins
from devicepulse.workload import views
from devicepulse.workload.views import SPEC

CHECKED = [
    "agg2_null_profile",
    "agg3_distinct_profile",
    "agg7_failing_device_count",
    "agg9_class_shares",
    "agg11_rows_per_device",
    "agg12_failing_devices_per_model",
    "agg13_gap_variety",
    "ded1_one_row_per_device_day",
    "ded2_distinct_rows",
    "ded3_first_of_each_gap",
    "win1_previous_date",
    "win3_cycles",
    "win4_cycle_numbers",
    "win5_forward_fill",
    "win6_lag_features",
    "win7_failed_cycles",
    "win_training_rows",
    "jon3_rows_of_failed_cycles",
    "jon5_telemetry_with_failed_cycles",
    "jon6_rows_of_each_split",
    "fea3_scale_for_training",
    "job1_drop_duplicates",
    "job2_preprocess",
    "mod3_weighted_f1",
    "srt1_device_day_order",
    "lim3_top_devices",
]
ROWS = 60_000


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    h = F.xxhash64("id")
    second = F.lit(1704067200) + F.pmod(h, F.lit(30 * 86400))
    hot = F.col("id") % 3 == 0
    one_day = hot & (F.col("id") % 2 == 0)
    rows = spark.range(ROWS).select(
        F.col("id").alias("event_id"),
        F.when(one_day, F.lit(1705276800) + F.pmod(h, F.lit(86400))).otherwise(second)
        .cast("timestamp").cast("timestamp_ntz").alias("ts"),
        F.when(hot, F.lit(7)).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(900))).alias("user_id"),
        F.element_at(
            F.array(*[F.lit(e) for e in ("view", "click", "error", "signup", "purchase")]),
            (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(5)) + 1).cast("int"),
        ).alias("event_type"),
        (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(20000)) / 100).alias("value"),
        F.concat(F.lit('{"k": '), F.pmod(h, F.lit(100)).cast("string"), F.lit("}")).alias("props"),
    )
    rows.repartition(16).write.parquet(str(folder / "events.parquet"))
    return str(folder)


@pytest.fixture(scope="module")
def con(hot_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{hot_dir}/events.parquet/*.parquet'")
    return con


def test_the_fixture_is_skewed(con):
    hot, one_day, rows = con.sql(
        "SELECT count(*) FILTER (WHERE user_id = 7), count(*) FILTER (WHERE user_id = 7 AND "
        "CAST(ts AS DATE) = DATE '2024-01-15'), count(*) FROM events"
    ).fetchall()[0]
    assert rows == ROWS and hot > rows / 3 and one_day > rows / 7


@pytest.mark.parametrize("name", CHECKED)
def test_equals_sql(spark, hot_dir, con, name):
    df = entry_module.queries()[name](spark, hot_dir)
    assert differences(df, con, entry_module.oracle_sql()[name]) == []


def _written_rows(df):
    """Run the query; the rows that each shuffle wrote, in plan order from the top."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    out = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return out


def test_hot_device_days_are_cut_before_the_shuffle(spark, hot_dir):
    days = dedup.one_row_per_day(views.readings(spark, hot_dir), SPEC, views.day_order())
    (written,) = _written_rows(days)
    # Sixteen map tasks at most, each sending a device-day at most once.
    hot_rows = ROWS / 6
    cold_rows = ROWS * 2 / 3
    assert written < cold_rows + 16 * 30 + 100 < ROWS - hot_rows


def test_hot_days_are_folded_before_the_cycle_shuffle(spark, hot_dir):
    written = _written_rows(cycles.cycle_rows(views.readings(spark, hot_dir), SPEC))
    assert max(written) < ROWS * 2 / 3 + 16 * 30 + 100


def test_hot_failing_days_are_folded_before_their_joins(spark, hot_dir, settings):
    """No side is small enough to broadcast; raw readings are the table of failures."""
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    settings("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    raw = views.readings(spark, hot_dir).withColumn("failure", F.lit(1))
    rows = cycles.cycle_rows(raw, SPEC)
    got = joins.rows_of_failed_cycles(rows, raw, SPEC)
    assert got.count() == rows.count()
    assert max(_written_rows(got)) < ROWS * 2 / 3 + 16 * 30 + 100
    targets = joins.attach_target(rows, raw, SPEC)
    assert max(_written_rows(targets)) < ROWS * 2 / 3 + 16 * 30 + 100
    assert targets.where("failure = 1").count() == rows.count()


def test_raw_rows_of_a_hot_day_are_split_at_run_time(spark, hot_dir, settings, con):
    """Cycle columns on raw readings: the partition of the hot device-day is read in pieces."""
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    settings("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    settings("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    settings("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    settings("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    raw = views.readings(spark, hot_dir)
    joined = joins.with_cycle_columns(raw, cycles.cycle_rows(raw, SPEC), SPEC)
    assert joined.count() == ROWS
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()

import pytest
from helpers import SPEC, bag, day, plan_of, rows_of, telemetry
from pyspark.sql import functions as F
from pyspark.sql import Window

from devicepulse.operators import cycles, dedup, joins


def _numbered(df):
    return rows_of(cycles.with_cycles(df, SPEC), "serial_number", "date", "cycle_seq")


def test_repeated_gap_opens_a_cycle_each_time(spark):
    df = telemetry(spark, [("A", d, 0, 0.0) for d in (1, 2, 4, 5, 7, 8)])
    assert [r[2] for r in _numbered(df)] == [1, 1, 2, 2, 3, 3]


def test_devices_never_share_a_cycle(spark):
    df = telemetry(spark, [(s, d, 0, 0.0) for s in "AB" for d in (1, 2, 3)])
    numbered = cycles.number_cycles(cycles.cycle_rows(df, SPEC), SPEC)
    assert rows_of(numbered, "serial_number", "cycle_id") == [("A", 1)] * 3 + [("B", 2)] * 3


def test_single_row_device(spark):
    df = cycles.with_cycles(telemetry(spark, [("A", 1, 0, 2.0)]), SPEC)
    row = cycles.lag_features(df, SPEC).first()
    assert row.cycle_seq == 1 and row.cycle_start == day(1)
    assert [row[f"smart_1_raw_lag_{k}"] for k in (1, 2, 3)] == [None] * 3


@pytest.mark.parametrize(("gap_days", "want"), [(1, [1, 1, 2]), (2, [1, 1, 1])])
def test_gap_boundary(spark, gap_days, want):
    df = telemetry(spark, [("A", d, 0, 0.0) for d in (1, 2, 4)])
    got = cycles.with_cycles(df, SPEC.with_(gap_days=gap_days))
    assert [r[1] for r in rows_of(got, "date", "cycle_seq")] == want


def test_cycle_rows_fold_repeated_days(spark):
    df = telemetry(spark, [("A", d, 0, float(i)) for i, d in enumerate((1, 1, 2, 2, 2, 4))])
    assert rows_of(cycles.cycle_rows(df, SPEC), "date", "cycle_seq") == [(day(1), 1), (day(2), 1), (day(4), 2)]


def test_repeated_days_are_refused_where_order_matters(spark):
    df = telemetry(spark, [("A", 1, 0, 0.0), ("A", 1, 0, 1.0)])
    keyed = df.withColumns({"cycle_seq": F.lit(1), "cycle_start": F.col("date")})
    for broken in (
        cycles.with_cycles(df, SPEC),
        cycles.previous_day(df, SPEC),
        cycles.forward_fill(df, ["smart_1_raw"], SPEC),
        cycles.lag_features(keyed, SPEC),
    ):
        with pytest.raises(Exception, match="keep one row per day"):
            broken.collect()


def test_lags_stay_within_the_cycle(spark):
    df = telemetry(spark, [("A", d, 0, float(d)) for d in (1, 2, 4, 5)])
    got = cycles.lag_features(cycles.with_cycles(df, SPEC), SPEC, num_lags=1)
    assert rows_of(got, "date", "smart_1_raw_lag_1") == [
        (day(1), None), (day(2), 1.0), (day(4), None), (day(5), 4.0),
    ]


def test_five_day_cycle_leaves_two_rows_after_the_null_drop(spark):
    df = telemetry(spark, [("A", d, 0, float(d)) for d in range(1, 6)])
    got = cycles.lag_features(cycles.with_cycles(df, SPEC), SPEC).na.drop("any")
    assert rows_of(got, "date") == [(day(4),), (day(5),)]


def test_no_lag_columns_are_honoured(spark):
    df = cycles.with_cycles(telemetry(spark, [("A", 1, 0, 1.0)]).withColumn("other", F.lit(1)), SPEC)
    got = cycles.lag_features(df, SPEC, no_lag_cols=[*SPEC.reserved, "other"])
    assert "smart_1_raw_lag_3" in got.columns and not [c for c in got.columns if c.startswith("other_lag")]


def test_lags_by_cycle_number_equal_lags_by_cycle_key(spark):
    df = telemetry(spark, [(s, d, 0, float(d)) for s in "AB" for d in (1, 2, 3, 5, 6)])
    wide = joins.with_cycle_columns(df, cycles.number_cycles(cycles.cycle_rows(df, SPEC), SPEC), SPEC)
    by_key = cycles.lag_features(wide, SPEC)
    assert bag(by_key) == bag(cycles.lag_features(wide, SPEC, cycle_key=["cycle_id"]))


def test_failed_cycles_by_window_and_by_join(spark):
    rows = [("A", 1, 0, 0.0), ("A", 2, 0, 0.0), ("A", 4, 0, 0.0), ("A", 5, 1, 0.0), ("B", 5, 0, 0.0)]
    df = telemetry(spark, rows)
    numbered = cycles.with_cycles(df, SPEC)
    kept = cycles.keep_failed_cycles(numbered, SPEC)
    assert rows_of(kept, "serial_number", "date") == [("A", day(4)), ("A", day(5))]
    joined = joins.rows_of_failed_cycles(cycles.cycle_rows(df, SPEC), df, SPEC)
    assert rows_of(joined, "serial_number", "date") == rows_of(kept, "serial_number", "date")


def test_null_target_is_not_a_failure(spark):
    df = telemetry(spark, [("A", 1, None, 0.0), ("A", 2, None, 0.0)])
    assert cycles.keep_failed_cycles(cycles.with_cycles(df, SPEC), SPEC).count() == 0


def test_forward_fill_does_not_cross_devices(spark):
    rows = [("A", 1, 0, 1.0), ("A", 2, 0, None), ("B", 1, 0, None), ("B", 2, 0, 3.0), ("B", 3, 0, None)]
    got = cycles.forward_fill(telemetry(spark, rows), ["smart_1_raw"], SPEC)
    assert rows_of(got, "serial_number", "date", "smart_1_raw") == [
        ("A", day(1), 1.0), ("A", day(2), 1.0), ("B", day(1), None), ("B", day(2), 3.0), ("B", day(3), 3.0),
    ]


def _many(spark):
    """60 devices with gaps of their own, each row once."""
    days = spark.range(60 * 50).select(
        F.concat(F.lit("S"), (F.col("id") % 60).cast("string")).alias("serial_number"),
        F.lit("M").alias("model"),
        F.date_add(F.lit(day(1)), (F.col("id") / 60).cast("int")).alias("date"),
        (F.xxhash64("id") % 29 == 0).cast("int").alias("failure"),
        (F.xxhash64("id") % 1000).cast("double").alias("smart_1_raw"),
    )
    return days.where(F.xxhash64("serial_number", "date") % 4 != 0)


@pytest.mark.parametrize("partitions", [1, 17])
def test_result_does_not_depend_on_partitioning(spark, partitions):
    def build(df):
        kept = cycles.keep_failed_cycles(cycles.with_cycles(dedup.one_row_per_day(df, SPEC), SPEC), SPEC)
        return bag(cycles.lag_features(kept, SPEC))

    df = _many(spark)
    assert build(df.repartition(partitions)) == build(df)


def test_every_device_day_is_in_one_cycle_and_neighbours_are_close(spark):
    df = _many(spark)
    got = cycles.with_cycles(df, SPEC)
    assert got.count() == df.count() == got.select(*SPEC.day_key).distinct().count()
    neighbours = Window.partitionBy(*SPEC.cycle_key).orderBy("date")
    widest = got.select(F.datediff("date", F.lag("date").over(neighbours)).alias("gap")).agg(F.max("gap"))
    assert widest.first()[0] == 1


def test_cycle_count_equals_session_windows(spark):
    df = _many(spark)
    by_gap = cycles.with_cycles(df, SPEC).select(*SPEC.cycle_key).distinct().count()
    session = F.session_window(F.col("date").cast("timestamp"), "1 day 1 second")
    assert by_gap == df.groupBy("serial_number", "model", session).count().count()


def test_numbers_are_dense_and_in_key_order(spark):
    numbered = cycles.number_cycles(cycles.cycle_rows(_many(spark), SPEC), SPEC)
    order = Window.orderBy(*SPEC.ids, "cycle_start")
    want = numbered.withColumn("want", F.dense_rank().over(order))
    assert want.where("want <> cycle_id").count() == 0
    assert want.agg(F.min("cycle_id"), F.max("cycle_id"), F.count_distinct("cycle_id")).first()[0] == 1


def test_numbering_keeps_devices_without_a_model(spark):
    df = telemetry(spark, [(s, d, 0, 0.0) for s in "AB" for d in (1, 2, 5)])
    df = df.withColumn("model", F.when(F.col("serial_number") == "A", F.col("model")))
    numbered = cycles.number_cycles(cycles.cycle_rows(df, SPEC), SPEC)
    assert rows_of(numbered, "serial_number", "cycle_id") == [(s, n) for s, n in zip("AAABBB", (1, 1, 2, 3, 3, 4))]


def test_first_row_per_gap_is_the_earliest(spark):
    df = telemetry(spark, [("A", d, 0, 0.0) for d in (1, 2, 4, 6, 7)])
    got = dedup.first_row_per_gap(cycles.day_gaps(df, SPEC), SPEC)
    assert rows_of(got, "gap_days", "date") == [(1, day(1)), (2, day(4))]


def test_cycles_and_lags_share_one_shuffle(spark):
    df = _many(spark)
    rows = dedup.one_row_per_day(df, SPEC)
    plan = plan_of(cycles.lag_features(cycles.keep_failed_cycles(cycles.with_cycles(rows, SPEC), SPEC), SPEC))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "SinglePartition" not in plan

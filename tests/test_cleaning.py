import re

import math

import pytest
from helpers import SPEC, bag, day, rows_of, telemetry
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicepulse.functions import SENTINELS
from devicepulse.operators import cleaning, dedup


def test_sentinels_are_nulled_by_type(spark):
    df = spark.createDataFrame(
        [(m, x, i, day(1)) for i, (m, x) in enumerate(
            [("NA", math.nan), ("na", math.inf), ("NaN", -math.inf), ("nan", 1.5), ("Infinity", 0.0),
             ("ok", None), (None, -0.5)]
        )],
        "text string, number double, n int, d date",
    )
    got = cleaning.parse_sentinels(df).orderBy("n").collect()
    assert [r.text for r in got] == [None] * 5 + ["ok", None]
    assert [r.number for r in got] == [None, None, None, 1.5, 0.0, None, -0.5]
    assert [r.n for r in got] == list(range(7))
    assert got[0].d == day(1)


def test_own_sentinel_list_leaves_the_rest(spark):
    df = spark.createDataFrame([("NA", math.nan), ("nan", math.inf)], "text string, number double")
    got = cleaning.parse_sentinels(df, ["NA"]).collect()
    assert got[0].text is None and got[1].text == "nan"
    assert math.isnan(got[0].number) and math.isinf(got[1].number)
    four = cleaning.parse_sentinels(df, ["NA", "na", "NaN", "nan"]).collect()
    assert four[0].number is None and math.isinf(four[1].number)


def test_sentinels_hold_the_documented_values():
    assert {"NA", "na", "NaN", "nan", "Infinity"} <= set(SENTINELS)


def test_numbers_are_restored_without_error(spark):
    df = spark.createDataFrame([("1.5", "x"), ("bad", "y"), (None, "z")], "a string, b string")
    assert [r.a for r in cleaning.restore_numbers(df, ["a"]).collect()] == [1.5, None, None]
    assert [r.b for r in cleaning.restore_numbers(df, ["a"]).collect()] == ["x", "y", "z"]


def _with_nulls(spark, four, five):
    rows = [(f"S{i}", "M", day(1), 0, four[i], five[i]) for i in range(10)]
    return spark.createDataFrame(
        rows, "serial_number string, model string, date date, failure int, a double, b double"
    )


def test_null_cutoff_is_strict(spark):
    df = _with_nulls(spark, [None] * 4 + [1.0] * 6, [None] * 5 + [1.0] * 5)
    assert cleaning.sparse_columns(df, SPEC) == ["b"]
    assert cleaning.dense_columns(df, SPEC) == ["date", "failure", "serial_number", "model", "a"]


def test_protected_columns_stay_however_sparse(spark):
    df = spark.createDataFrame(
        [("S", "M", day(1), None, None)] * 3,
        "serial_number string, model string, date date, failure int, a double",
    )
    assert cleaning.sparse_columns(df, SPEC) == ["a"]


def test_empty_input_drops_nothing_by_nulls(spark):
    df = telemetry(spark, [])
    assert cleaning.sparse_columns(df, SPEC) == []


def test_constant_columns(spark):
    df = spark.createDataFrame(
        [("S", "M", day(1), 0, None, 1.0, 1.0, math.nan), ("S", "M", day(2), 0, None, None, 2.0, math.nan)],
        "serial_number string, model string, date date, failure int, none double, one double, two double, nan double",
    )
    assert cleaning.constant_columns(df, SPEC) == ["none", "one", "nan"]


def test_select_by_manifest_orders_casts_and_checks(spark):
    df = spark.createDataFrame([("7", 1), ("NA", 2)], "a string, b int")
    layout = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.DoubleType())])
    got = cleaning.select_as(df, layout)
    assert got.dtypes == [("b", "bigint"), ("a", "double")]
    assert [tuple(r) for r in got.orderBy("b").collect()] == [(1, 7.0), (2, None)]
    with pytest.raises(ValueError, match="missing"):
        cleaning.select_as(df, ["a", "c"])


def test_completeness_counts_what_the_null_drop_takes(spark):
    df = _with_nulls(spark, [None] * 4 + [1.0] * 6, [1.0] * 5 + [None] * 5)
    report = cleaning.completeness(df).first()
    assert (report.rows, report.kept, report.dropped) == (10, cleaning.drop_incomplete(df).count(), 9)


def test_fill_touches_only_the_named_column(spark):
    df = _with_nulls(spark, [None] * 10, [None] * 10)
    got = cleaning.fill_missing(df, 1.0, ["a"]).first()
    assert got.a == 1.0 and got.b is None


def test_tied_duplicates_keep_the_failure(spark):
    df = telemetry(spark, [("A", 1, 0, 1.0), ("A", 1, 1, 5.0), ("A", 1, 1, 4.0), ("B", 1, 0, 2.0)])
    for n in (1, 17):
        got = dedup.one_row_per_day(df.repartition(n), SPEC)
        assert rows_of(got, "serial_number", "failure", "smart_1_raw") == [("A", 1, 4.0), ("B", 0, 2.0)]


def test_dedup_without_target_and_without_payload(spark):
    df = telemetry(spark, [("A", 1, 0, 1.0), ("A", 1, 0, 1.0), ("A", 2, 0, 1.0)])
    assert dedup.one_row_per_day(df.drop("failure"), SPEC).count() == 2
    assert dedup.one_row_per_day(df.select(*SPEC.day_key), SPEC).count() == 2


def test_distinct_rows(spark):
    df = telemetry(spark, [("A", 1, 0, 1.0), ("A", 1, 0, 1.0), ("A", 1, 0, 2.0)])
    assert dedup.distinct_rows(df).count() == 2


def test_rows_with_target_and_added_columns(spark):
    df = telemetry(spark, [("A", 1, 0, 1.0), ("A", 2, 1, 3.0)])
    got = cleaning.add_columns(cleaning.rows_with_target(df, SPEC), {"twice": F.col("smart_1_raw") * 2})
    assert rows_of(got, "twice") == [(6.0,)]


def test_mostly_unique_keys_give_the_same_rows(spark):
    rows = [("A", 1, 0, 1.0), ("A", 1, 1, 5.0), ("A", 1, 1, 4.0), ("A", 2, 0, 1.0), ("B", 1, 0, 2.0), ("B", 1, 0, 2.0)]
    df = telemetry(spark, [*rows, *[("C", d, 0, 1.0) for d in range(1, 30)]])
    df = df.union(spark.createDataFrame([(None, "M", day(1), 0, 1.0)] * 2, df.schema))
    want = bag(dedup.one_row_per_day(df, SPEC))
    order = dedup.failing_first(df, SPEC)
    assert bag(dedup.one_row_per_mostly_unique_key(df, SPEC.day_key, order)) == want
    assert bag(dedup.one_row_per_day(df, SPEC, mostly_unique=True)) == want


def test_mostly_unique_keys_have_one_plan_and_start_no_job(spark):
    def shape(df):
        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("plan", "plan")
        made = dedup.one_row_per_day(df, SPEC, mostly_unique=True)
        assert list(tracker.getJobIdsForGroup("plan")) == []
        spark.sparkContext.setJobGroup("other", "other")
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "ResolvedHint" not in plan
        return re.findall(r"Join \w+|Aggregate|Window", plan)

    unique = telemetry(spark, [("C", d, 0, 1.0) for d in range(1, 30)])
    assert shape(unique) == shape(telemetry(spark, [("C", 1, 0, 1.0)] * 29))

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import Window

from devicepulse.operators import ranking
from helpers import shuffled_rows


@pytest.mark.parametrize("rows", [0, 1, 5, 4000])
def test_dense_numbers(spark, rows):
    df = spark.range(rows).select(F.xxhash64("id").alias("key")).repartition(13)
    got = ranking.dense_number(df, ["key"], "number")
    want = got.withColumn("want", F.row_number().over(Window.orderBy("key")))
    assert got.count() == rows
    assert want.where("want <> number").count() == 0


def test_running_total_restarts_within(spark):
    df = spark.range(3000).select(
        (F.col("id") % 3).alias("part"), F.xxhash64("id").alias("key"), (F.col("id") % 7).alias("n")
    )
    got = ranking.running_total(df, ["key"], F.col("n"), "total", within=["part"])
    own = Window.partitionBy("part").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    assert got.withColumn("want", F.sum("n").over(own)).where("want <> total").count() == 0


@pytest.mark.parametrize("every", [1, 7, 3000, 10**9])
def test_values_are_carried_over_ranges(spark, every):
    rows = spark.range(6000).select(
        F.xxhash64("id").alias("key"), F.when(F.col("id") % every == every // 2, F.col("id")).alias("a"), F.lit("x").alias("other")
    )
    own = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    got = ranking.carry_forward(rows.repartition(9), ["key"], ["a"])
    want = rows.withColumn("want", F.last("a", ignorenulls=True).over(own)).select("key", "want")
    assert got.columns == rows.columns
    assert got.join(want, "key").where(~F.col("a").eqNullSafe(F.col("want"))).count() == 0
    assert got.count() == 6000


def test_nothing_is_carried_where_there_are_no_rows(spark):
    assert ranking.carry_forward(spark.createDataFrame([], "key int, a int"), ["key"], ["a"]).count() == 0


def _quantiles(df, columns, points):
    rows = ranking.exact_quantiles(df, columns, points).collect()
    return {(r.column_name, r.probability): r.quantile for r in rows}


def test_exact_quantiles_equal_numpy_where_one_value_dominates(spark):
    points = [0.0, 0.25, 0.3333, 0.5, 0.75, 1.0]
    values = np.concatenate([np.full(4000, 3.25), np.arange(6001) / 7])
    df = spark.createDataFrame([(float(v), None if i % 5 == 0 else float(-v)) for i, v in enumerate(values)], "a double, b double")
    got = _quantiles(df.repartition(11), ["a", "b"], points)
    some = np.array([-v for i, v in enumerate(values) if i % 5])
    for p in points:
        assert got["a", p] == pytest.approx(np.quantile(values, p), abs=1e-9)
        assert got["b", p] == pytest.approx(np.quantile(some, p), abs=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=40))
def test_exact_quantiles_of_any_list(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "a double")
    got = _quantiles(df, ["a"], [0.25, 0.75])
    assert got["a", 0.25] == pytest.approx(np.quantile(values, 0.25))
    assert got["a", 0.75] == pytest.approx(np.quantile(values, 0.75))


def test_quantiles_of_an_all_null_column_are_absent(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    assert set(_quantiles(df, ["a", "b"], [0.5])) == {("a", 0.5)}


def test_quantiles_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    cases = {
        "powers": [2.0**k for k in range(-1000, 1000)] + [-(2.0**k) for k in range(-1000, 1000)],
        "ends": [-inf] * 900 + [1.0, 2.0] + [inf] * 900,
        "unknown": [1.0] * 10 + [nan] * 30,
        "zeros": [-0.0, 0.0] * 1500,
        "one": [7.0],
    }
    points = [0.0, 0.1, 0.25, 0.5, 0.50001, 0.9, 1.0]
    for values in cases.values():
        got = _quantiles(spark.createDataFrame([(v,) for v in values], "a double").repartition(5), ["a"], points)
        in_order = sorted(values, key=lambda v: (v != v, v if v == v else 0))
        for p in points:
            position = (len(values) - 1) * p
            low, high = in_order[int(np.floor(position))], in_order[int(np.ceil(position))]
            want = low if low == high else low + (high - low) * (position - np.floor(position))
            assert got["a", p] == pytest.approx(want, rel=1e-12, nan_ok=True)


@pytest.mark.parametrize("points", [5, 40])
def test_a_sketch_that_misses_costs_a_round_and_not_the_result(spark, monkeypatch, points):
    monkeypatch.setattr(ranking, "SKETCH_POINTS", points)
    monkeypatch.setattr(ranking, "SKETCH_ACCURACY", 3)
    monkeypatch.setattr(ranking, "FEW_VALUES", 20)
    rnd = np.random.default_rng(2)
    values = np.concatenate([rnd.normal(size=3000), np.full(500, 0.25)])
    got = _quantiles(spark.createDataFrame([(float(v),) for v in values], "a double"), ["a"], [0.01, 0.5, 0.6, 0.99])
    for (_, p), x in got.items():
        assert x == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_a_million_values_are_not_moved(spark):
    """No task of a shuffle gets more than a few rows of counts or sketches, or the last few values."""
    n = 1_000_000
    df = spark.range(0, n, 1, 16).select(
        (F.col("id") * 7919 % n).cast("double").alias("a"), F.pow(F.lit(1.00001), F.col("id") % n).alias("b")
    )
    with shuffled_rows(spark) as written:
        got = _quantiles(df, ["a", "b"], [0.25, 0.5, 0.75])
    for p in (0.25, 0.5, 0.75):
        assert got["a", p] == (n - 1) * p
    # Sixteen tasks send a count per part of a column or a sketch per column, or a list per last range.
    assert written and max(written) < 16 * 60


def test_limits(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 10).alias("n"))
    assert [r.id for r in ranking.first_rows(df, ["id"], 3).collect()] == [0, 1, 2]
    assert ranking.any_rows(df, 7).count() == 7
    assert [r.id for r in ranking.top_by_count(df, "n", ["id"], 2).collect()] == [9, 19]
    assert [r.id for r in ranking.sort_rows(df, [F.col("n").desc(), "id"]).limit(2).collect()] == [9, 19]

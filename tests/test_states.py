import pytest
from helpers import bag, shuffled_rows
from pyspark.sql import functions as F

from devicepulse.operators import profiling, ranking, states


@pytest.fixture
def rows(spark):
    h = F.xxhash64("id")
    return spark.range(4000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("day"),
        F.when(F.pmod(h, F.lit(5)) > 0, F.pmod(h, F.lit(700))).alias("n"),
        F.when(F.pmod(h, F.lit(3)) == 0, (F.pmod(h, F.lit(50)) / 3)).alias("x"),
        F.when(F.col("id") % 9 == 4, F.lit("only")).alias("word"),
        F.lit(None).cast("double").alias("nothing"),
        F.lit(True).alias("always"),
    )


def profile_of_all(rows):
    nulls, distinct = profiling.null_profile(rows), profiling.distinct_profile(rows)
    constant = profiling.constant_profile(rows)
    joined = nulls.join(distinct, "column_name").join(constant, "column_name")
    return joined.withColumn("rows", F.lit(rows.count()).cast("bigint"))


def test_merged_days_equal_the_whole(spark, rows, tmp_path):
    paths = str(tmp_path / "states"), str(tmp_path / "values")
    # Days come one by one, two of them twice, the first time with other rows.
    wrong = rows.where(F.dayofmonth("day").isin(2, 3)).withColumn("n", F.lit(10**9).cast("bigint"))
    for part in [wrong, *[rows.where(F.dayofmonth("day") == d) for d in range(1, 10)]]:
        states.save_days(states.day_states(part, "day"), paths[0], "day")
        states.save_days(states.day_values(part, "day"), paths[1], "day")
    stored = spark.read.parquet(paths[0])
    assert bag(states.merged_profile(stored, spark.read.parquet(paths[1]))) == bag(profile_of_all(rows))
    sketched = {r.column_name: r.distinct_count for r in states.merged_profile(stored).collect()}
    for r in profile_of_all(rows).collect():
        assert abs(sketched[r.column_name] - r.distinct_count) <= 0.05 * r.distinct_count


def test_a_column_that_comes_later_is_null_before(spark, rows):
    early, late = rows.where("day < '2024-01-05'"), rows.where("day >= '2024-01-05'")
    both = states.day_states(early.drop("x"), "day").unionByName(states.day_states(late, "day"))
    got = {r.column_name: r.null_count for r in states.merged_profile(both).collect()}
    assert got["x"] == early.count() + late.where("x IS NULL").count()


def test_no_days(spark, rows):
    assert states.merged_profile(states.day_states(rows.limit(0), "day")).count() == 0


@pytest.mark.parametrize("buckets", [4, 1 << 12])
@pytest.mark.parametrize("kind", ["skewed", "even", "ties", "few"])
def test_first_by_bounds_equal_all_counts(spark, kind, buckets):
    key = {
        "skewed": F.pow(F.pmod(F.xxhash64("id"), F.lit(1000)) / 20, F.lit(2)).cast("bigint"),
        "even": F.col("id") % 700,
        "ties": F.when(F.col("id") < 900, F.col("id") % 30).otherwise(F.col("id")),
        "few": F.when(F.col("id") % 3 > 0, F.col("id") % 3),
    }[kind]
    rows = spark.range(9000).select(key.alias("key"), (F.col("id") % 2).alias("half"))
    for columns in (["key"], ["key", "half"]):
        want = ranking.top_by_count(profiling.value_counts(rows, columns), "rows", columns, 7)
        got = profiling.top_counts(rows, columns, 7, buckets)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_most_values_are_not_moved(spark):
    """A million values once, ten of them a thousand times."""
    rows = spark.range(0, 1_010_000, 1, 8).select(
        F.when(F.col("id") < 10_000, F.col("id") % 10).otherwise(F.col("id")).alias("key")
    )
    with shuffled_rows(spark) as written:
        got = profiling.top_counts(rows, ["key"], 10).collect()
    assert {(r.key, r.rows) for r in got} == {(k, 1000) for k in range(10)}
    assert sum(written) < 600_000 < rows.count()


def test_nothing_to_count(spark):
    assert profiling.top_counts(spark.createDataFrame([], "key int"), ["key"], 5).count() == 0

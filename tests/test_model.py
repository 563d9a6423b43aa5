import math

import pytest
from helpers import SPEC, bag, day, rows_of
from pyspark.sql import functions as F

from devicepulse.operators import cleaning, model, scaling, splitting


def _cycles(spark, n):
    return spark.range(n * 3).select(
        F.concat(F.lit("S"), (F.col("id") % n).cast("string")).alias("serial_number"),
        F.lit("M").alias("model"),
        F.date_add(F.lit(day(1)), (F.col("id") / n).cast("int")).alias("date"),
        F.lit(1).cast("bigint").alias("cycle_seq"),
        (F.col("id") % 2).cast("int").alias("failure"),
        F.col("id").cast("double").alias("a"),
    )


def test_split_is_whole_disjoint_and_independent_of_partitioning(spark):
    df = _cycles(spark, 1000)
    named = splitting.with_split(df, SPEC)
    per_cycle = named.groupBy("serial_number").agg(F.count_distinct("split").alias("n"))
    assert per_cycle.where("n <> 1").count() == 0
    shares = {r.split: r.rows / 3000 for r in named.groupBy("split").agg(F.count("*").alias("rows")).collect()}
    assert shares["train"] == pytest.approx(0.8, abs=0.05)
    assert shares["val"] == pytest.approx(0.1, abs=0.04)
    assert shares["test"] == pytest.approx(0.1, abs=0.04)
    members = [bag(splitting.with_split(df.repartition(n), SPEC).select("serial_number", "split")) for n in (1, 17)]
    assert members[0] == members[1]
    parts = splitting.split_by_cycle(df, SPEC)
    assert sum(p.count() for p in parts) == 3000
    assert parts.train.columns == ["failure", "a"]


def test_seed_changes_the_members(spark):
    df = _cycles(spark, 300)
    first, second = (bag(splitting.with_split(df, SPEC.with_(seed=s)).select("serial_number", "split")) for s in (1, 2))
    assert first != second


@pytest.fixture
def table(spark):
    rows = [(i % 2, float(i), 5.0, i * 1e-312) for i in range(101)]
    return spark.createDataFrame(rows, "failure int, wide double, flat double, tiny double")


@pytest.mark.parametrize("exact", [True, False])
def test_scaling_of_wide_flat_and_tiny_ranges(table, exact):
    columns = ["wide", "flat", "tiny"]
    if exact:
        scaled = scaling.scale_by_factors(table, scaling.exact_factors(table, columns), ["failure"])
    else:
        scaled = scaling.scale_features(table, scaling.fit_scaler(table, columns), columns, ["failure"])
    assert scaled.columns == ["failure", *columns]
    last = scaled.orderBy(F.col("wide").desc()).first()
    assert last.wide == pytest.approx(2.0, rel=0.02)
    assert last.flat == 0.0
    assert math.isinf(last.tiny)
    cleaned = scaling.clean_scaled(splitting.Splits(scaled, scaled.limit(3), scaled.limit(0)), SPEC)
    for part in cleaned:
        assert part.columns == ["failure", "wide", "flat"]


def test_infinity_only_in_validation_is_nulled_and_the_column_kept(spark):
    train = spark.createDataFrame([(0, 1.0)], "failure int, a double")
    val = spark.createDataFrame([(0, math.inf)], "failure int, a double")
    cleaned = scaling.clean_scaled(splitting.Splits(train, val, train), SPEC)
    assert cleaned.val.columns == ["failure", "a"]
    assert cleaned.val.first().a is None


def test_sketched_range_is_near_the_exact_one(spark):
    df = spark.range(50_000).select((F.xxhash64("id") % 10_000).cast("double").alias("a"))
    exact = scaling.exact_factors(df, ["a"])["a"]
    sketched = 1 / scaling.fit_scaler(df, ["a"]).stages[1].range[0]
    assert sketched == pytest.approx(exact, rel=0.02)


def test_assemble_refuses_nulls(spark):
    df = spark.createDataFrame([(0, None)], "failure int, a double")
    with pytest.raises(Exception, match="(?i)null"):
        scaling.assemble(df, ["a"], ["failure"]).collect()


def test_vectors_unpack_to_what_was_assembled(table):
    vectors = scaling.assemble(table, ["wide", "flat"], ["failure"])
    assert rows_of(cleaning.unpack_vector(vectors, "features", ["wide", "flat"], ["failure"])) == rows_of(
        table.select("failure", "wide", "flat")
    )


@pytest.mark.parametrize(
    "pairs",
    [
        [(0, 0), (0, 1), (1, 1), (1, 1), (1, 0)],
        [(0, 0), (1, 0), (1, 0)],
        [(0, 1), (1, 0)],
        [(0, 0), (0, 0)],
        [(0, 2), (1, 1), (2, 0), (2, 2)],
    ],
)
def test_weighted_f1_equals_the_evaluator(spark, pairs):
    df = spark.createDataFrame([(t, float(p)) for t, p in pairs], "failure int, prediction double")
    ours = model.weighted_f1(model.confusion(df, "failure")).first().f1
    assert ours == pytest.approx(model.evaluate(df, SPEC))


def test_classifier_learns_and_scores_each_set(spark):
    df = spark.range(400).select(
        (F.col("id") % 4 == 0).cast("int").alias("failure"), (F.col("id") % 4).cast("double").alias("a")
    )
    vectors = scaling.assemble(df, ["a"], ["failure"])
    fitted = model.fit_classifier(vectors, SPEC, maxIter=2)
    predicted = model.predict(fitted, vectors)
    assert {"rawPrediction", "probability", "prediction"} <= set(predicted.columns)
    scores = model.score_splits(splitting.Splits(predicted, predicted, predicted.limit(0)), SPEC).first()
    assert scores.asDict() == {"metricName": "f1", "train": 1.0, "val": 1.0, "test": None}

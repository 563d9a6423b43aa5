"""Jobs on inputs that once lost rows, columns or the right scaler."""

import pytest
from helpers import SPEC, bag, day
from pyspark.sql import functions as F

from devicepulse.operators import cycles, dedup, joins, model
from devicepulse.operators.splitting import Splits
from devicepulse.plans import jobs
from devicepulse.sources import write_table

SCHEMA = "serial_number string, model string, date date, failure int, a double, whole string, mixed string, vendor string"


def readings(spark, devices=24, days=14, scale=1.0):
    rows = []
    for d in range(devices):
        for n in range(1, days + 1):
            x = (d * 37 + n * 11) % 97
            mixed = "x1" if (d, n) == (2, 3) else str(x / 2)
            model_name = "NA" if d % 4 == 0 else "M"
            whole = "NA" if n == 99 else str(9007199254740993 + x)
            rows.append((f"00{d}", model_name, day(n), int(n % 5 == 0), x * scale, whole, mixed, f"v{x % 3}"))
    return spark.createDataFrame(rows, SCHEMA)


def preprocessed(spark, folder, rows):
    layout = jobs.Layout(str(folder))
    write_table(rows, f"{folder}/source")
    jobs.drop_duplicates_job(spark, f"{folder}/source", layout, SPEC, fmt="parquet")
    return layout, jobs.preprocess_job(spark, layout, SPEC)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    return preprocessed(spark, tmp_path_factory.mktemp("run"), readings(spark))


def test_text_columns_are_kept_and_reported(spark, run):
    layout, training = run
    cleaned = layout.read(spark, "cleaned")
    types = dict(cleaned.dtypes)
    assert types["vendor"] == types["mixed"] == "string" and types["whole"] == "bigint"
    assert cleaned.where("vendor IS NULL OR mixed IS NULL OR whole IS NULL").count() == 0
    assert cleaned.agg(F.min("whole")).first()[0] >= 9007199254740993
    report = spark.read.json(layout.artefact("unparsed_cells")).first()
    assert report.text_columns == 2 and report.vendor == cleaned.count() and report.mixed == 1
    assert "vendor" in training.columns and "vendor_lag_1" not in training.columns


def test_devices_named_like_a_marker_are_kept(spark, run):
    layout, _ = run
    assert layout.read(spark, "cleaned").where("model = 'NA'").count() > 0
    failed, rows = layout.read(spark, "failed_cycle"), layout.read(spark, "failed_rows")
    assert failed.count() == rows.count() == layout.read(spark, "cleaned").count()


def test_both_ways_to_failed_cycles_agree_on_null_keys(spark):
    rows = readings(spark).withColumn("model", F.when(F.col("model") != "NA", F.col("model")))
    found = cycles.with_cycles(rows.select(*SPEC.day_key, "failure"), SPEC)
    kept = cycles.keep_failed_cycles(found, SPEC)
    joined = joins.rows_of_failed_cycles(found, rows, SPEC)
    assert bag(kept) == bag(joined) and kept.where("model IS NULL").count() > 0
    assert joins.with_cycle_columns(rows, found.drop("failure"), SPEC).count() == rows.count()


def test_a_model_is_never_used_with_factors_of_another_run(spark, run):
    layout, _ = run
    jobs.feature_job(spark, layout, SPEC)
    jobs.train_job(spark, layout, SPEC, maxIter=2)
    assert jobs.inference_job(spark, layout, SPEC).count() > 0
    jobs.feature_job(spark, layout, SPEC, exact=True)
    with pytest.raises(ValueError, match="other scaling factors"):
        jobs.inference_job(spark, layout, SPEC)
    jobs.train_job(spark, layout, SPEC, maxIter=2)
    kit = jobs.ScoringKit.load(spark, layout, SPEC)
    assert kit.factors == jobs.load_factors(spark, layout)[1]
    assert jobs.inference_job(spark, layout, SPEC).count() > 0


def test_rows_that_scaling_leaves_incomplete_are_dropped_and_counted(spark, tmp_path):
    layout, training = preprocessed(spark, tmp_path, readings(spark))
    # All rows of one cycle go to validation and hold a number that scaling makes infinite.
    chosen = (F.col("serial_number") == "001") & (F.col("model") == "M")
    broken = training.withColumn("a", F.when(chosen, F.lit(1.7e308)).otherwise(F.col("a") / 1e6))
    layout.write(spark.createDataFrame(broken.collect(), broken.schema), "training", "overwrite")
    splits = jobs.feature_job(spark, layout, SPEC, exact=True, bucket=F.when(chosen, 850).otherwise(1))
    report = spark.read.json(layout.artefact("scaled_rows")).first()
    assert report.rows_val == report.dropped_val > 0 and report.dropped_train == report.dropped_test == 0
    assert splits.train.count() == report.rows_train and splits.val.count() == 0
    assert jobs.train_job(spark, layout, SPEC, maxIter=2).first().train is not None


@pytest.mark.parametrize("parts", [1, 17])
def test_first_days_of_raw_rows_with_repeats(spark, run, tmp_path, parts):
    layout, _ = run
    jobs.feature_job(spark, layout, SPEC)
    jobs.train_job(spark, layout, SPEC, maxIter=2)
    raw = readings(spark)
    repeated = raw.union(raw.withColumn("a", F.col("a") + 1000)).repartition(parts)
    write_table(repeated, str(tmp_path / "raw"), "csv")
    got = jobs.inference_job(spark, layout, SPEC, str(tmp_path / "raw"), "csv", nrows=30)
    first = dedup.one_row_per_day(repeated, SPEC).orderBy(*SPEC.day_key).limit(30)
    kit = jobs.ScoringKit.load(spark, layout, SPEC)
    want = jobs.score_rows(first, kit, SPEC, True)
    columns = [*SPEC.day_key, "prediction"]
    assert bag(got.select(*columns)) == bag(want.select(*columns)) and got.count() > 0
    assert all(r.serial_number.startswith("00") for r in got.collect())
    report = spark.read.json(layout.artefact("scored_rows")).first()
    assert report.rows == 30 and report.kept == got.count()
    assert report.without_lags + report.after_scaling == report.dropped == 30 - report.kept


def test_metrics_are_what_their_names_say(spark):
    rows = [(0, 0.0)] * 5 + [(0, 1.0)] * 2 + [(1, 1.0)] * 3 + [(1, 0.0)] * 4 + [(2, 0.0)]
    part = spark.createDataFrame(rows, "failure int, prediction double")
    for metric in model.METRICS:
        spec = SPEC.with_(metric=metric)
        scores = model.score_splits(Splits(part, part, part), spec).first()
        assert scores.metricName == metric and abs(scores.val - model.evaluate(part, spec)) < 1e-12
    with pytest.raises(ValueError, match="metric"):
        model.score_splits(Splits(part, part, part), SPEC.with_(metric="auc"))

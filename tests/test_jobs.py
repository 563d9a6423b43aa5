import sys

import pytest
from helpers import SPEC, bag, plan_of
from pyspark.sql import functions as F

from devicepulse.operators import cycles, model, scaling
from devicepulse.plans import cli, jobs
from devicepulse.sources import load_manifest, save_manifest, write_table
from devicepulse.spec import TelemetrySpec


def _raw(spark):
    """40 devices over 40 days, with gaps, repeats, markers, a sparse and a constant column."""
    h = F.xxhash64("device", "n")
    rows = spark.range(1600).select((F.col("id") % 40).alias("device"), (F.col("id") / 40).cast("int").alias("n"))
    rows = rows.where(F.pmod(h, F.lit(11)) != 0)
    wide = rows.select(
        F.date_add(F.lit("2016-01-01").cast("date"), F.col("n")).alias("date"),
        F.concat(F.lit("S"), F.col("device").cast("string")).alias("serial_number"),
        F.concat(F.lit("M"), (F.col("device") % 3).cast("string")).alias("model"),
        (F.pmod(h, F.lit(13)) == 0).cast("int").alias("failure"),
        (F.pmod(h, F.lit(97)) + 50 * (F.pmod(h, F.lit(13)) == 0).cast("int")).cast("double").alias("smart_1_raw"),
        F.when(F.pmod(h, F.lit(19)) == 0, "NA")
        .otherwise(F.pmod(h, F.lit(53)).cast("string"))
        .alias("smart_5_raw"),
        F.when(F.pmod(h, F.lit(2)) == 0, F.lit(1.0)).alias("smart_199_raw"),
        F.lit(100.0).alias("smart_1_normalized"),
    )
    return wide.union(wide.where(F.col("failure") == 1).withColumn("failure", F.lit(0)))


@pytest.fixture(scope="module", params=["parquet", "csv", "buckets"])
def run(request, spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp(f"run_{request.param}")
    source, root = str(folder / "source"), str(folder / "root")
    raw = _raw(spark)
    write_table(raw, source, "csv")
    layout = jobs.Layout(root, buckets=4) if request.param == "buckets" else jobs.Layout(root, request.param)
    spec = TelemetrySpec()
    out = {"layout": layout, "raw": raw, "source": source, "spec": spec}
    out["deduplicated"] = jobs.drop_duplicates_job(spark, source, layout, spec, schema=raw.schema)
    out["training"] = jobs.preprocess_job(spark, layout, spec, number_cycles=True)
    out["splits"] = jobs.feature_job(spark, layout, spec)
    out["scores"] = jobs.train_job(spark, layout, spec, maxIter=3)
    out["predictions"] = jobs.inference_job(spark, layout, spec)
    return out


def test_deduplicated_keeps_failures(run):
    rows = run["deduplicated"]
    assert rows.count() == rows.select(*SPEC.day_key).distinct().count()
    assert rows.where("failure = 1").count() == run["raw"].where("failure = 1").count()


def test_rerun_does_not_overwrite_by_default(spark, run):
    with pytest.raises(Exception, match="(?i)exists"):
        jobs.drop_duplicates_job(spark, run["source"], run["layout"], run["spec"], schema=run["raw"].schema)


def test_training_table(spark, run):
    training = run["training"]
    assert "smart_199_raw" not in training.columns, "half null"
    assert "smart_1_normalized" not in training.columns, "constant"
    assert dict(training.dtypes)["smart_5_raw"] == "bigint"
    assert "smart_5_raw_lag_3" in training.columns and "cycle_id" in training.columns
    assert training.count() == training.na.drop("any").count() > 0
    in_memory = run["layout"].read(spark, "cleaned").drop("smart_1_normalized")
    chain = cycles.keep_failed_cycles(cycles.with_cycles(in_memory, SPEC), SPEC)
    want = cycles.lag_features(chain, SPEC).na.drop("any")
    assert bag(training.drop("cycle_id")) == bag(want)
    report = spark.read.json(run["layout"].artefact("training_rows")).first()
    assert report.kept == training.count() and report.rows == chain.count()
    assert report.dropped == report.rows - report.kept


def test_failed_cycle_table_is_a_part_of_the_cycle_table(spark, run):
    every, failed = run["layout"].read(spark, "cycle"), run["layout"].read(spark, "failed_cycle")
    assert every.count() == run["deduplicated"].count()
    assert failed.join(every, every.columns[:3], "left_anti").count() == 0
    assert bag(failed) == bag(every.where("cycle_failed").drop("cycle_failed"))


def test_splits(spark, run):
    splits = run["splits"]
    assert sum(part.count() for part in splits) == run["training"].count()
    assert splits.train.columns == splits.val.columns == splits.test.columns
    assert splits.train.na.drop("any").count() == splits.train.count()


def test_scores(run):
    scores = run["scores"].first()
    assert scores.metricName == "f1"
    assert scores.train > 0.9


def test_saved_artefacts_score_as_in_memory(spark, run):
    kit = jobs.ScoringKit.load(spark, run["layout"], run["spec"])
    assert SPEC.target_col not in kit.preprocessed.names
    assert run["predictions"].columns == [
        "serial_number", "model", "date", "features", "rawPrediction", "probability", "prediction",
    ]
    rows = run["layout"].read(spark, "cleaned")
    lagged = cycles.lag_features(cycles.with_cycles(rows.drop("failure"), SPEC), SPEC).na.drop("any")
    scaled = scaling.scale_by_factors(lagged, kit.factors, SPEC.day_key)
    want = model.predict(kit.classifier, scaling.assemble(scaled, kit.features.names, SPEC.day_key))
    columns = [*SPEC.day_key, "prediction"]
    assert bag(run["predictions"].select(*columns)) == bag(want.select(*columns))
    assert run["predictions"].count() > 0


def test_raw_rows_score_as_cleaned_rows(spark, run):
    kit = jobs.ScoringKit.load(spark, run["layout"], run["spec"])
    columns = [*SPEC.day_key, "prediction"]
    from_raw = jobs.score_rows(run["raw"], kit, SPEC).select(*columns)
    assert bag(from_raw) == bag(run["predictions"].select(*columns))


def test_scoring_unique_days_takes_one_shuffle(spark, run):
    kit = jobs.ScoringKit.load(spark, run["layout"], run["spec"])
    cleaned = run["layout"].read(spark, "cleaned")
    assert plan_of(jobs.score_rows(cleaned, kit, SPEC, True)).count("Exchange hashpartitioning") == 1
    assert plan_of(jobs.score_rows(cleaned, kit, SPEC)).count("Exchange hashpartitioning") == 2


def test_unscored_rows_are_reported(spark, run):
    report = spark.read.json(run["layout"].artefact("scored_rows")).first()
    assert report.rows == run["deduplicated"].count()
    assert report.kept == run["predictions"].count() and report.dropped == report.rows - report.kept > 0


def test_exact_scaling_is_near_the_sketched(spark, run, tmp_path):
    layout = run["layout"]
    training = layout.read(spark, "training")
    other = jobs.Layout(str(tmp_path), layout.fmt)
    other.write(training, "training", "overwrite")
    exact = jobs.feature_job(spark, other, run["spec"], exact=True)
    assert exact.train.columns == run["splits"].train.columns
    assert exact.train.count() == run["splits"].train.count()
    _, factors = jobs.load_factors(spark, other)
    assert list(factors) == load_manifest(spark, other.manifest("num_feature")).names


# From here on the predictions are overwritten.


def test_first_rows_only(spark, run):
    few = jobs.inference_job(spark, run["layout"], run["spec"], nrows=50)
    assert 0 < few.count() <= 50


def test_command_line(spark, run, tmp_path, monkeypatch):
    save_manifest(run["raw"], str(tmp_path / "schema"))
    root = ["--root", str(tmp_path / "root")]
    monkeypatch.setattr(sys, "argv", ["cli"])
    cli.main(["drop-duplicates", *root, "--source", run["source"], "--schema", str(tmp_path / "schema")])
    cli.main(["preprocess", *root])
    cli.main([
        "drop-duplicates", *root, "--source", run["source"], "--schema", str(tmp_path / "schema"),
        "--mostly-unique", "--mode", "overwrite",
    ])
    layout = jobs.Layout(str(tmp_path / "root"))
    assert bag(layout.read(spark, "training")) == bag(run["training"].drop("cycle_id"))
    assert bag(layout.read(spark, "deduplicated")) == bag(run["deduplicated"])
    with pytest.raises(SystemExit):
        cli.main(["drop-duplicates", *root])


def test_new_source_is_deduplicated_and_reported(spark, run):
    """The raw CSV with repeated device-days, scored by the job."""
    scored = jobs.inference_job(
        spark, run["layout"], run["spec"], run["source"], "csv", schema=run["raw"].schema
    )
    columns = [*SPEC.day_key, "prediction"]
    kit = jobs.ScoringKit.load(spark, run["layout"], run["spec"])
    cleaned = run["layout"].read(spark, "cleaned")
    assert bag(scored.select(*columns)) == bag(jobs.score_rows(cleaned, kit, SPEC, True).select(*columns))
    report = spark.read.json(run["layout"].artefact("scored_rows")).first()
    assert (report.rows, report.kept) == (run["deduplicated"].count(), scored.count())

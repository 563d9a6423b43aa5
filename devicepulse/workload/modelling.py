"""Split, scaling, model and the five jobs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicepulse.functions import SENTINELS
from devicepulse.operators import cleaning, model, ranking, scaling, splitting
from devicepulse.plans import jobs
from devicepulse.sources import pin, read_table, scratch_path, write_table
from devicepulse.workload import views
from devicepulse.workload.registry import query
from devicepulse.workload.storage import GUESS_SQL, bucket, guesses
from devicepulse.workload.views import FEATURES, SPEC

_KEY = "user_id, device_model, date"
_BUCKET = "((user_id % 1000003) * 7919 + cycle_seq * 104729) % 1000"
_SPLIT = f"CASE WHEN {_BUCKET} < 800 THEN 'train' WHEN {_BUCKET} < 900 THEN 'val' ELSE 'test' END"


@query(f"WITH {views.CYCLES_SQL} SELECT {_KEY}, cycle_seq, {_SPLIT} AS split FROM cyc")
def spl1_split_by_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = splitting.with_split(views.cycle_days(spark, sf_dir), SPEC, bucket=bucket())
    return named.select(*SPEC.day_key, "cycle_seq", "split")


@query(
    f"""WITH {views.CYCLES_SQL} SELECT user_id, device_model, cycle_seq, count(*) AS rows,
  CAST(1 AS BIGINT) AS sets FROM cyc GROUP BY user_id, device_model, cycle_seq"""
)
def spl1_split_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the default hash, which SQL does not have: every cycle whole and in one set."""
    parts = splitting.split_by_cycle(views.cycle_days(spark, sf_dir), SPEC, drop=[])
    tagged = [part.withColumn("split", F.lit(name)) for name, part in parts._asdict().items()]
    rows = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    return rows.groupBy(*SPEC.cycle_key).agg(
        F.count("*").alias("rows"), F.count_distinct("split").alias("sets")
    )


@query(
    f"""WITH {views.DAYS_SQL} SELECT {_KEY}, CAST(reading AS DOUBLE) AS reading, CAST(hour AS DOUBLE) AS hour
FROM days"""
)
def fea1_assemble_for_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.slim_days(spark, sf_dir)
    vectors = scaling.assemble(rows, FEATURES, SPEC.day_key, output="unscaled")
    return cleaning.unpack_vector(vectors, "unscaled", FEATURES, SPEC.day_key)


def _range_bounds(column: str) -> str:
    def at(p):
        return f"quantile_cont(CAST({column} AS DOUBLE), {p})"

    return f"""SELECT '{column}' AS column_name, round({at(0.73)} - {at(0.27)}, 6) AS least,
  round({at(0.77)} - {at(0.23)}, 6) AS most, TRUE AS range_is_between FROM shipment_days"""


@query(
    f"WITH {views.SHIPMENT_DAYS_SQL} "
    + " UNION ALL ".join(_range_bounds(c) for c in ("quantity", "price", "discount", "tax"))
)
def fea2_fitted_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted scaler's ranges come from a sketch: each lies between the exact ranges two
    percent of the ranks inside and outside the quartiles."""
    columns = ["quantity", "price", "discount", "tax"]
    # Stored, as the sketch and every round of the quantiles read them: duplicates are removed once.
    rows = pin(views.shipment_days(spark, sf_dir).select(*columns))
    ranges = scaling.fit_scaler(rows, columns).stages[1].range
    named = {c: float(r) for c, r in zip(columns, ranges, strict=True)}
    fitted = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    points = (0.23, 0.27, 0.73, 0.77)
    exact = ranking.exact_quantiles(rows, columns, points).groupBy("column_name").agg(
        *[F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(f"at{int(p * 100)}") for p in points]
    )
    least, most = F.col("at73") - F.col("at27"), F.col("at77") - F.col("at23")
    return exact.select(
        "column_name",
        F.round(least, 6).alias("least"),
        F.round(most, 6).alias("most"),
        fitted[F.col("column_name")].between(least, most).alias("range_is_between"),
    )


@query(
    f"WITH {views.SHIPMENT_DAYS_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS probability,
        round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS quantile FROM shipments"""
        for c in ("quantity", "price", "discount", "tax")
        for p in (0.25, 0.75)
    )
)
def fea2_exact_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["quantity", "price", "discount", "tax"]
    quartiles = ranking.exact_quantiles(views.shipments(spark, sf_dir), columns, [0.25, 0.75])
    return quartiles.withColumn("quantile", F.round("quantile", 6))


_FACTORS_SQL = """
factors AS (
  SELECT 1 / (quantile_cont(CAST(reading AS DOUBLE), 0.75) - quantile_cont(CAST(reading AS DOUBLE), 0.25)) AS r,
         1 / (quantile_cont(CAST(hour AS DOUBLE), 0.75) - quantile_cont(CAST(hour AS DOUBLE), 0.25)) AS h
  FROM days)"""


@query(
    f"""WITH {views.DAYS_SQL}, {_FACTORS_SQL}
SELECT {_KEY}, round(reading * r, 6) AS reading, round(hour * h, 6) AS hour FROM days, factors"""
)
def fea3_scale_for_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device and date carried along, as in scoring."""
    rows = pin(views.slim_days(spark, sf_dir))
    scaled = scaling.scale_by_factors(rows, scaling.exact_factors(rows, FEATURES), SPEC.day_key)
    return scaled.withColumns({c: F.round(c, 6) for c in FEATURES})


@query(
    f"""WITH {views.DAYS_SQL}, {_FACTORS_SQL}
SELECT failure, round(reading * r, 6) AS reading, round(hour * h, 6) AS hour FROM days, factors"""
)
def fea3_scale_for_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target carried along, as in training."""
    rows = pin(views.slim_days(spark, sf_dir))
    scaled = scaling.scale_by_factors(rows, scaling.exact_factors(rows, FEATURES), [SPEC.target_col])
    return scaled.withColumns({c: F.round(c, 6) for c in FEATURES})


@query(
    f"WITH {views.DAYS_SQL} SELECT {_KEY}, TRUE AS reading_is_scaled, TRUE AS hour_is_scaled FROM days"
)
def fea3_scale_by_fitted_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's own scaling: every value times one over its fitted range."""
    rows = pin(views.slim_days(spark, sf_dir))
    scaler = scaling.fit_scaler(rows, FEATURES)
    scaled = scaling.scale_features(rows, scaler, FEATURES, SPEC.day_key)
    raw = rows.select(*SPEC.day_key, *[F.col(c).alias(f"raw_{c}") for c in FEATURES])
    both = scaled.join(raw, SPEC.day_key)
    ranges = dict(zip(FEATURES, map(float, scaler.stages[1].range), strict=True))
    near = [
        (F.abs(F.col(c) * ranges[c] - F.col(f"raw_{c}")) <= 1e-9 * F.abs(f"raw_{c}")).alias(f"{c}_is_scaled")
        for c in FEATURES
    ]
    return both.select(*SPEC.day_key, *near)


@query(
    f"""WITH {views.CYCLES_SQL},
scaled AS (SELECT failure, CAST(reading AS DOUBLE) AS reading, {_SPLIT} AS split FROM cyc)
SELECT split, failure, reading FROM scaled"""
)
def fea4_clean_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`tiny` overflows when it is divided by its minute range; it is dropped from all three sets."""
    rows = views.cycle_days(spark, sf_dir).select(
        "*", (F.col("reading") * F.lit(1e-313)).alias("tiny"), F.col("reading").cast("double").alias("whole")
    )
    splits = splitting.split_by_cycle(pin(rows), SPEC, bucket=bucket())
    factors = {"tiny": scaling.exact_factors(splits.train, ["tiny"])["tiny"], "whole": 1.0}
    scaled = splits.map(lambda part: scaling.scale_by_factors(part, factors, [SPEC.target_col]))
    clean = scaling.clean_scaled(scaled, SPEC)
    tagged = [
        part.withColumnRenamed("whole", "reading").withColumn("split", F.lit(name))
        for name, part in clean._asdict().items()
    ]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


_MODEL_FEATURES = [*FEATURES, *[f"{c}_lag_{k}" for c in FEATURES for k in (1, 2, 3)]]


@query(
    f"WITH {views.LAGS_SQL} SELECT failure, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _MODEL_FEATURES)
    + " FROM training"
)
def fea5_assemble_for_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = scaling.assemble(views.training(spark, sf_dir), _MODEL_FEATURES, [SPEC.target_col])
    return cleaning.unpack_vector(vectors, "features", _MODEL_FEATURES, [SPEC.target_col])


def _vectors(spark: SparkSession, sf_dir: str) -> splitting.Splits:
    """The lagged rows, stored once, as model input."""
    path = scratch_path(spark, "training")
    write_table(views.training(spark, sf_dir), path)
    rows = read_table(spark, path)
    features = SPEC.numeric_feature_cols(rows)
    splits = splitting.split_by_cycle(rows, SPEC, bucket=bucket())
    return splits.map(lambda part: scaling.assemble(part, features, [SPEC.target_col]))


@query(
    f"""WITH {views.LAGS_SQL} SELECT count(*) AS rows, TRUE AS better_than_guessing
FROM training WHERE {_SPLIT} = 'train'"""
)
def mod1_fit_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which trees are fitted is not SQL's to say: they must beat the larger class as a guess."""
    vectors = _vectors(spark, sf_dir)
    fitted = model.fit_classifier(vectors.train, SPEC)
    predicted = model.predict(fitted, vectors.train)
    right = F.count_if(F.col("prediction") == F.col("failure"))
    larger = F.greatest(F.count_if(F.col("failure") == 1), F.count_if(F.col("failure") == 0))
    return predicted.agg(F.count("*").alias("rows"), (right > larger).alias("better_than_guessing"))


@query(
    f"""WITH {views.LAGS_SQL}
SELECT {_SPLIT} AS split, failure, count(*) AS rows, count(*) AS predicted FROM training GROUP BY ALL"""
)
def mod2_predict_each_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of each set gets one prediction, 0 or 1."""
    vectors = _vectors(spark, sf_dir)
    fitted = model.fit_classifier(vectors.train, SPEC)
    predicted = vectors.map(lambda part: model.predict(fitted, part))
    tagged = [
        part.select(F.lit(name).alias("split"), SPEC.target_col, "prediction")
        for name, part in predicted._asdict().items()
    ]
    rows = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    return rows.groupBy("split", "failure").agg(
        F.count("*").alias("rows"), F.count_if(F.col("prediction").isin(0.0, 1.0)).alias("predicted")
    )


@query(GUESS_SQL + "SELECT split, round(f1, 9) AS f1 FROM scores")
def mod3_weighted_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = model.confusion(guesses(spark, sf_dir), SPEC.target_col, by=["split"])
    return model.weighted_f1(counts, by=["split"]).withColumn("f1", F.round("f1", 9))


_METRICS_SQL = GUESS_SQL + """
SELECT split, round(sum(2 * hits / (actual + guessed) * actual) / sum(actual), 9) AS f1,
       round(sum(hits) / sum(actual), 9) AS accuracy,
       round(sum(CASE WHEN guessed > 0 THEN hits / guessed ELSE 0 END * actual) / sum(actual), 9)
         AS "weightedPrecision",
       round(sum(CASE WHEN actual > 0 THEN hits / actual ELSE 0 END * actual) / sum(actual), 9)
         AS "weightedRecall"
FROM classes GROUP BY split"""


@query(_METRICS_SQL)
def mod3_weighted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = model.confusion(guesses(spark, sf_dir), SPEC.target_col, by=["split"])
    made = model.weighted_metrics(counts, by=["split"])
    return made.select("split", *[F.round(m, 9).alias(m) for m in model.METRICS])


def _stored_readings(spark: SparkSession, sf_dir: str) -> tuple[str, jobs.Layout, DataFrame]:
    """The raw readings as a CSV folder, and a place for a run."""
    source = scratch_path(spark, "readings")
    rows = views.readings(spark, sf_dir).drop("event_id")
    write_table(rows, source, "csv")
    return source, jobs.Layout(scratch_path(spark, "run")), rows


def _deduplicated(spark: SparkSession, sf_dir: str) -> jobs.Layout:
    source, layout, rows = _stored_readings(spark, sf_dir)
    jobs.drop_duplicates_job(spark, source, layout, SPEC, schema=rows.schema)
    return layout


def _trained(spark: SparkSession, sf_dir: str, exact: bool = False) -> jobs.Layout:
    layout = _deduplicated(spark, sf_dir)
    jobs.preprocess_job(spark, layout, SPEC)
    jobs.feature_job(spark, layout, SPEC, exact=exact, bucket=bucket())
    return layout


_VALUES = "reading, hour, k_text, ratio, sparse, partial, fleet, firmware"
_JOB1_SQL = (
    views.READINGS_SQL
    + f""",
job_placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY {_KEY}
    ORDER BY failure DESC, {", ".join(f"{c} NULLS FIRST" for c in _VALUES.split(", "))}) AS place
  FROM readings),
job_days AS (SELECT {_KEY}, failure, {_VALUES} FROM job_placed WHERE place = 1)"""
)


@query(
    f"""WITH {_JOB1_SQL} SELECT {_KEY}, failure, reading, hour, k_text, sparse, partial, fleet, firmware,
  {views.RATIO_SQL} FROM job_days"""
)
def job1_drop_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.told_ratio(_deduplicated(spark, sf_dir).read(spark, "deduplicated"))


_TRAINED = ["reading", "hour", "k_text", "ratio", "partial"]
_TRAINED_LAGS = [f"{c}_lag_{k}" for c in _TRAINED for k in (1, 2, 3)]
_JOB2_SQL = (
    _JOB1_SQL
    + f""",
job_clean AS (
  SELECT {_KEY}, failure, reading, hour,
         CASE WHEN k_text NOT IN {SENTINELS}
              THEN TRY_CAST(k_text AS BIGINT) END AS k_text,
         CASE WHEN NOT isnan(ratio) AND NOT isinf(ratio) THEN ratio END AS ratio, partial
  FROM job_days),
job_gaps AS (
  SELECT *, CAST(date - lag(date) OVER (PARTITION BY user_id, device_model ORDER BY date) AS INTEGER) AS gap
  FROM job_clean),
job_cyc AS (
  SELECT * EXCLUDE (gap),
    CAST(sum(CASE WHEN gap IS NULL OR gap > 1 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS cycle_seq,
    max(CASE WHEN gap IS NULL OR gap > 1 THEN date END) OVER w AS cycle_start
  FROM job_gaps WINDOW w AS (PARTITION BY user_id, device_model ORDER BY date
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
job_failed AS (
  SELECT * EXCLUDE (worst) FROM (
    SELECT *, max(failure) OVER (PARTITION BY user_id, device_model, cycle_seq) AS worst FROM job_cyc)
  WHERE worst = 1),
job_lagged AS (
  SELECT *, {", ".join(f"lag({c}, {k}) OVER w AS {c}_lag_{k}" for c in _TRAINED for k in (1, 2, 3))}
  FROM job_failed WINDOW w AS (PARTITION BY user_id, device_model, cycle_seq ORDER BY date)),
job_training AS (
  SELECT * FROM job_lagged
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in [*_TRAINED, *_TRAINED_LAGS])})"""
)


@query(
    f"""WITH {_JOB2_SQL} SELECT {_KEY}, failure, cycle_seq, cycle_start, {", ".join([*_TRAINED, *_TRAINED_LAGS])}
FROM job_training"""
)
def job2_preprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _deduplicated(spark, sf_dir)
    return jobs.preprocess_job(spark, layout, SPEC)


_SCALED = [*_TRAINED, *_TRAINED_LAGS]


@query(
    f"""WITH {_JOB2_SQL},
job_split AS (SELECT *, {_SPLIT} AS split FROM job_training),
job_factors AS (
  SELECT {", ".join(
        f"1 / (quantile_cont(CAST({c} AS DOUBLE), 0.75) - quantile_cont(CAST({c} AS DOUBLE), 0.25)) AS f_{c}"
        for c in _SCALED
    )} FROM job_split WHERE split = 'train')
SELECT split, failure, {", ".join(f"round({c} * f_{c}, 6) AS {c}" for c in _SCALED)}
FROM job_split, job_factors"""
)
def job3_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three sets, with exact quartile ranges so that SQL can follow."""
    splits = jobs.read_splits(spark, _trained(spark, sf_dir, exact=True))
    tagged = [part.withColumn("split", F.lit(name)) for name, part in splits._asdict().items()]
    rows = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    return rows.select("split", "failure", *[F.round(c, 6).alias(c) for c in _SCALED])


@query(
    f"""WITH {_JOB2_SQL}, job_sets AS (SELECT {_SPLIT} AS split FROM job_training)
SELECT 'f1' AS "metricName", count(*) FILTER (WHERE split = 'train') > 0 AS train_scored,
  count(*) FILTER (WHERE split = 'val') > 0 AS val_scored,
  count(*) FILTER (WHERE split = 'test') > 0 AS test_scored FROM job_sets"""
)
def job4_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score record of the fitted model: a share for every set that has rows."""
    scores = jobs.train_job(spark, _trained(spark, sf_dir), SPEC)
    return scores.select(
        "metricName",
        *[
            F.coalesce(F.col(s).between(0.0, 1.0), F.lit(False)).alias(f"{s}_scored")
            for s in splitting.Splits._fields
        ],
    )


_SCORED_SQL = f"""WITH {_JOB2_SQL},
new_lagged AS (
  SELECT *, {", ".join(f"lag({c}, {k}) OVER w AS {c}_lag_{k}" for c in _TRAINED for k in (1, 2, 3))}
  FROM job_cyc WINDOW w AS (PARTITION BY user_id, device_model, cycle_seq ORDER BY date))
SELECT {_KEY}, TRUE AS scored FROM new_lagged
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in [*_TRAINED, *_TRAINED_LAGS])}"""


@query(_SCORED_SQL)
def mod4_scored_device_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which device-days of the raw readings get a prediction, by the saved artefacts."""
    layout = _trained(spark, sf_dir)
    jobs.train_job(spark, layout, SPEC)
    kit = jobs.ScoringKit.load(spark, layout, SPEC)
    new_rows = views.readings(spark, sf_dir).drop("event_id")
    scored = jobs.score_rows(new_rows, kit, SPEC)
    return scored.select(*SPEC.day_key, F.col("prediction").isin(0.0, 1.0).alias("scored"))


@query(_SCORED_SQL.replace("TRUE AS scored", "TRUE AS saved_as_in_memory"))
def job5_exact_saved_as_in_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on exact factors: predictions by the saved artefacts, and by exact factors computed anew and
    the model at hand, which must agree on every device-day."""
    layout = _trained(spark, sf_dir, exact=True)
    jobs.train_job(spark, layout, SPEC)
    saved = jobs.inference_job(spark, layout, SPEC)
    kit = jobs.ScoringKit.load(spark, layout, SPEC)
    named = splitting.with_split(layout.read(spark, "training"), SPEC, bucket=bucket())
    anew = scaling.exact_factors(named.where("split = 'train'"), kit.num_features.names)
    complete = cleaning.drop_incomplete(jobs.scoring_rows(layout.read(spark, "cleaned"), kit, SPEC, True))
    scaled = scaling.scale_by_factors(complete, anew, SPEC.day_key)
    at_hand = model.predict(kit.classifier, scaling.assemble(scaled, kit.features.names, SPEC.day_key))
    other = at_hand.select(*SPEC.day_key, F.col("prediction").alias("_other"))
    both = saved.join(other, SPEC.day_key)
    return both.select(*SPEC.day_key, (F.col("prediction") == F.col("_other")).alias("saved_as_in_memory"))


@query(_SCORED_SQL)
def job5_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for the cleaned table, as written."""
    layout = _trained(spark, sf_dir)
    jobs.train_job(spark, layout, SPEC)
    predictions = jobs.inference_job(spark, layout, SPEC)
    return predictions.select(*SPEC.day_key, F.col("prediction").isin(0.0, 1.0).alias("scored"))


@query(_SCORED_SQL.replace("TRUE AS scored", "TRUE AS same_as_at_once"))
def mod4_scored_by_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw readings in three parts, one after the other, each with the stored tails of the days before: the
    same device-days get the same predictions as all readings at once give."""
    layout = _trained(spark, sf_dir)
    jobs.train_job(spark, layout, SPEC)
    rows = views.readings(spark, sf_dir).drop("event_id")
    first, last = rows.agg(F.min("date"), F.max("date")).first()
    step = (last - first) // 3
    edges = [first, first + step, first + 2 * step, last + timedelta(days=1)]
    found = None
    for i, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        part = jobs.new_days_job(spark, layout, SPEC, rows.where(F.col("date").between(low, high - timedelta(days=1))), str(i))
        found = part if found is None else found.unionByName(part)
    at_once = jobs.score_rows(rows, jobs.ScoringKit.load(spark, layout, SPEC), SPEC)
    other = at_once.select(*SPEC.day_key, F.col("prediction").alias("_other"))
    both = found.join(other, SPEC.day_key, "full")
    same = F.coalesce(F.col("prediction") == F.col("_other"), F.lit(False))
    return both.select(*SPEC.day_key, same.alias("same_as_at_once"))

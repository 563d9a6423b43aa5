"""Boosted-tree classifier, its predictions and its score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicepulse.operators.splitting import Splits
from devicepulse.sources.workspace import shared_folder
from devicepulse.spec import TelemetrySpec


def fit_classifier(train: DataFrame, spec: TelemetrySpec, **params) -> GBTClassificationModel:
    """Fit on `target` and `features`; `params` go to the classifier. Every few rounds it cuts its
    lineage in the shared folder.
    """
    shared_folder(train.sparkSession)
    classifier = GBTClassifier(
        labelCol=spec.target_col, featuresCol="features", seed=spec.seed, **params
    )
    return classifier.fit(train)


def predict(model: GBTClassificationModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def confusion(predictions: DataFrame, label: str, prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    return predictions.groupBy(
        *by,
        F.col(label).cast("double").alias("label"),
        F.col(prediction).cast("double").alias("prediction"),
    ).agg(F.count("*").alias("rows"))


# The shares that a confusion table gives, by the evaluator's names for them.
METRICS = ("f1", "accuracy", "weightedPrecision", "weightedRecall")


def weighted_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each class's F1, precision and recall weighted by its rows, and the share of right predictions, from
    a confusion table: one column for each of `METRICS`.

    Each cell counts once for its true class and once for its predicted one. A class that is never
    predicted has precision 0.
    """
    n, zero = F.col("rows"), F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)
    both = F.array(
        F.struct(
            F.col("label").alias("class"), n.alias("actual"), zero.alias("guessed"), hit.alias("hits")
        ),
        F.struct(
            F.col("prediction").alias("class"), zero.alias("actual"), n.alias("guessed"), zero.alias("hits")
        ),
    )
    per_class = (
        counts.select(*by, F.inline(both))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "guessed", "hits")])
    )
    f1 = 2.0 * F.col("hits") / (F.col("actual") + F.col("guessed"))
    precision = F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("guessed")), F.lit(0.0))
    right = F.sum("hits") / F.sum("actual")
    return per_class.groupBy(*by).agg(
        (F.sum(f1 * F.col("actual")) / F.sum("actual")).alias("f1"),
        right.alias("accuracy"),
        (F.sum(precision * F.col("actual")) / F.sum("actual")).alias("weightedPrecision"),
        # Recall of a class times its rows is its hits.
        right.alias("weightedRecall"),
    )


def weighted_f1(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """F1 of each class weighted by its rows, from a confusion table."""
    return weighted_metrics(counts, by).select(*by, "f1")


def score_splits(predicted: Splits, spec: TelemetrySpec) -> DataFrame:
    """One row: the metric's name and its value on each set, in one job over all three."""
    if spec.metric not in METRICS:
        raise ValueError(f"metric {spec.metric!r} is not one of {METRICS}")
    names = list(Splits._fields)
    tagged = None
    for name, part in zip(names, predicted, strict=True):
        rows = part.select(F.lit(name).alias("split"), spec.target_col, "prediction")
        tagged = rows if tagged is None else tagged.unionByName(rows)
    per_split = weighted_metrics(confusion(tagged, spec.target_col, by=["split"]), by=["split"])
    return per_split.agg(
        F.any_value(F.lit(spec.metric)).alias("metricName"),
        *[F.max(F.when(F.col("split") == s, F.col(spec.metric))).alias(s) for s in names],
    )


def evaluate(predictions: DataFrame, spec: TelemetrySpec, metric: str | None = None) -> float:
    """The metric by Spark's own evaluator."""
    return MulticlassClassificationEvaluator(
        labelCol=spec.target_col, predictionCol="prediction", metricName=metric or spec.metric
    ).evaluate(predictions)

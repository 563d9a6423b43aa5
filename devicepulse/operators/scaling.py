"""Quartile-range scaling and the clean-up after it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import RobustScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicepulse.operators.cleaning import parse_sentinels, sparse_columns, unpack_vector
from devicepulse.operators.ranking import exact_quantiles
from devicepulse.operators.splitting import Splits
from devicepulse.spec import TelemetrySpec


def assemble(
    df: DataFrame, feature_cols: Sequence[str], keep: Sequence[str], output: str = "features"
) -> DataFrame:
    """The carried columns and the feature vector. A null or NaN feature is an error: clean first."""
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol=output)
    return assembler.transform(df).select(*keep, output)


def fit_scaler(df_train: DataFrame, feature_cols: Sequence[str], relative_error: float = 0.001) -> PipelineModel:
    """Scale by the quartile range, without centring; quartiles by a mergeable sketch, so that
    nothing grows with the rows. `exact_factors` is the exact form.
    """
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol="unscaled")
    scaler = RobustScaler(
        inputCol="unscaled", outputCol="scaled", relativeError=relative_error
    )
    return Pipeline(stages=[assembler, scaler]).fit(df_train)


def scale_features(
    df: DataFrame, scaler: PipelineModel, feature_cols: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """The carried columns (target for training, device and date for scoring) and the scaled features."""
    return unpack_vector(scaler.transform(df), "scaled", feature_cols, keep)


def exact_factors(df_train: DataFrame, feature_cols: Sequence[str]) -> dict[str, float]:
    """One over the exact interpolated quartile range of each column, 0 for a zero range.

    One number per column reaches the driver.
    """
    quartiles = exact_quantiles(df_train, feature_cols, [0.25, 0.75])
    ranges = quartiles.groupBy("column_name").agg((F.max("quantile") - F.min("quantile")).alias("range"))
    by_name = {r.column_name: r.range for r in ranges.collect()}
    return {c: 1.0 / by_name[c] if by_name.get(c) else 0.0 for c in feature_cols}


def fitted_factors(df_train: DataFrame, feature_cols: Sequence[str], relative_error: float = 0.001) -> dict[str, float]:
    """The same by the fitted scaler's sketch."""
    ranges = fit_scaler(df_train, feature_cols, relative_error).stages[1].range
    return {c: 1.0 / float(r) if r else 0.0 for c, r in zip(feature_cols, ranges, strict=True)}


def scale_by_factors(df: DataFrame, factors: dict[str, float], keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, *[(F.col(f"`{c}`") * F.lit(x)).alias(c) for c, x in factors.items()])


def clean_scaled(splits: Splits, spec: TelemetrySpec) -> Splits:
    """Null out what scaling made infinite or NaN in all three sets, then drop from all three the
    columns that hold a null in train.
    """
    cleaned = splits.map(parse_sentinels)
    dropped = sparse_columns(cleaned.train, spec, cutoff=0.0)
    return cleaned.map(lambda part: part.drop(*dropped))

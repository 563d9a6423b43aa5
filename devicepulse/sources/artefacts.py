"""Fitted scaler and model on disk."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel


def save_artefact(fitted, path: str, overwrite: bool = True) -> None:
    writer = fitted.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_scaler(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_classifier(path: str) -> GBTClassificationModel:
    return GBTClassificationModel.load(path)

"""Column manifests: the ordered names and types of a stage's table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def save_manifest(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    # One literal row: a row shipped from Python would cost a worker.
    line = df.sparkSession.range(1).coalesce(1).select(F.lit(df.schema.json()).alias("value"))
    line.write.mode(mode).text(path)


def load_manifest(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(path).first()[0]))


def without_target(schema: T.StructType, target_col: str) -> T.StructType:
    """The same manifest for rows that carry no label yet."""
    return T.StructType([f for f in schema.fields if f.name != target_col])

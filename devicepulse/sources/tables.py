"""Tables in and out. Every write is distributed; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Read a file or a folder of parts.

    CSV has a header. With a schema it is read once and its header is checked against the
    schema; without one Spark infers the types, which costs a further pass over the text.
    Only `columns` are read where they are given.
    """
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
        else:
            reader = reader.schema(schema).option("enforceSchema", False)
    elif schema is not None:
        reader = reader.schema(schema)
    df = reader.format(fmt).load(path)
    return df if columns is None else df.select(*columns)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
) -> None:
    """Write parts. `mode` is `errorifexists` unless the caller asks to overwrite."""
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_scores(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write evaluation scores as JSON lines. A score table has one row, hence one file."""
    scores.coalesce(1).write.mode(mode).json(path)

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devicepulse.sources.workspace import scratch_path

# A word is a run of anything but these; a Java and a RE2 character class alike.
SPACES = r"\x20\x09-\x0D"
Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for a null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACES}]+"), "")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and go on from the written table, so that lost executors cost no
    recomputation and later steps read only the columns that they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches, so that what a task holds in Python objects stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sized(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of a slice take about `most_bytes`; one row at least."""
    for batch in batches:
        begin, held = 0, 0
        for row, n in enumerate(pc.binary_length(batch.column(column)).fill_null(0).to_pylist()):
            if held and held + n > most_bytes:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += n
        if begin < batch.num_rows:
            yield batch.slice(begin)

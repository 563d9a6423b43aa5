"""Cell cleaning, column choice and row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicepulse.functions import SENTINELS, as_number, null_sentinels
from devicepulse.operators.profiling import constant_flags, null_fractions
from devicepulse.spec import TelemetrySpec


def parse_sentinels(df: DataFrame, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """Null out missing-value markers in every column, in one projection."""
    return df.select([null_sentinels(f, sentinels) for f in df.schema.fields])


def restore_numbers(
    df: DataFrame, columns: Sequence[str] | None = None, data_type: str = "double"
) -> DataFrame:
    """Turn text columns into numbers (default: every text column given), in one projection."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    chosen = set(columns)
    return df.select([as_number(c, data_type) if c in chosen else F.col(f"`{c}`") for c in df.columns])


def sparse_columns(df: DataFrame, spec: TelemetrySpec, cutoff: float | None = None) -> list[str]:
    """Columns whose null fraction is strictly above the cutoff; protected ones never are.

    On empty input there is no fraction and nothing is dropped. One row reaches the driver.
    """
    limit = spec.null_cutoff if cutoff is None else cutoff
    return [
        c
        for c, fraction in null_fractions(df).items()
        if fraction is not None and fraction > limit and c not in spec.protected
    ]


def dense_columns(df: DataFrame, spec: TelemetrySpec, cutoff: float | None = None) -> list[str]:
    """The complement: columns to keep, protected ones first."""
    dropped = set(sparse_columns(df, spec, cutoff))
    first = [c for c in spec.protected if c in df.columns]
    return first + [c for c in df.columns if c not in dropped and c not in first]


def constant_columns(df: DataFrame, spec: TelemetrySpec) -> list[str]:
    """Columns with fewer than two distinct values, all-null ones included."""
    return [c for c, constant in constant_flags(df).items() if constant and c not in spec.reserved]


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def select_as(df: DataFrame, layout: Sequence[str] | T.StructType) -> DataFrame:
    """Columns in the order of a list or a saved manifest.

    A manifest also fixes the types: a column is cast where its type differs (text that is no
    number becomes null). A missing column is an error before any row is read.
    """
    names = layout.names if isinstance(layout, T.StructType) else list(layout)
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")
    if not isinstance(layout, T.StructType):
        return df.select(*[F.col(f"`{c}`") for c in names])
    have = {f.name: f.dataType for f in df.schema.fields}

    def typed(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if have[field.name] == field.dataType:
            return column
        if isinstance(have[field.name], T.StringType):
            column = column.try_cast(field.dataType)
        else:
            column = column.cast(field.dataType)
        return column.alias(field.name)

    return df.select(*[typed(f) for f in layout.fields])


def add_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add computed columns in one projection."""
    return df.withColumns(dict(columns))


def unpack_vector(
    df: DataFrame, vector_col: str, names: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """One named column per vector element, after the carried columns."""
    unpacked = df.select(*keep, vector_to_array(vector_col).alias("_elements"))
    return unpacked.select(*keep, *[F.col("_elements").getItem(i).alias(c) for i, c in enumerate(names)])


def rows_with_target(df: DataFrame, spec: TelemetrySpec, value: int = 1) -> DataFrame:
    return df.where(F.col(spec.target_col) == value)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any null."""
    return df.na.drop("any", subset=None if columns is None else list(columns))


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How many rows `drop_incomplete` keeps and drops, in one pass."""
    any_null = None
    for c in columns or df.columns:
        test = F.col(f"`{c}`").isNull()
        any_null = test if any_null is None else any_null | test
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(~any_null).alias("kept"),
        F.count_if(any_null).alias("dropped"),
    )


def fill_missing(df: DataFrame, value, columns: Sequence[str]) -> DataFrame:
    return df.na.fill(value, subset=list(columns))

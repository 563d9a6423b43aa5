"""Column expressions used by more than one operator. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing reading. The source this serves lists only the
# positive infinity; both are missing here.
SENTINELS = ("NA", "na", "NaN", "nan", "Infinity", "-Infinity")


def null_sentinels(field: T.StructField, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The column with missing-value markers turned to null, by its type.

    Texts are compared with the list. Fractional numbers lose NaN and infinities, if the list
    names them. Other types cannot hold a marker and pass through, so that no number or date
    is ever compared with a text (an error under ANSI mode).
    """
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        missing = column.isin(list(sentinels))
    elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        tests = []
        if {"NaN", "nan"} & set(sentinels):
            tests.append(F.isnan(column))
        if "Infinity" in sentinels:
            tests.append(F.abs(column) == F.lit(float("inf")))
        if not tests:
            return column
        missing = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    else:
        return column
    return F.when(missing, None).otherwise(column).alias(field.name)


def as_number(name: str, data_type: str = "double") -> Column:
    """Text to number; what is not a number becomes null."""
    return F.col(f"`{name}`").try_cast(data_type).alias(name)


def day_gap(date: str | Column, previous: str | Column) -> Column:
    """Whole days from `previous` to `date`; null if either is null."""
    return F.datediff(date, previous)


def hash_bucket(keys: Sequence[str], seed: int, buckets: int = 1000) -> Column:
    """A bucket in [0, buckets) that depends on nothing but the key values and the seed."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(buckets))

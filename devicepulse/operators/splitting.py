"""Train, validation and test sets by whole cycles."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicepulse.functions import hash_bucket
from devicepulse.spec import TelemetrySpec

BUCKETS = 1000


class Splits(NamedTuple):
    train: DataFrame
    val: DataFrame
    test: DataFrame

    def map(self, change) -> Splits:
        return Splits(*[change(part) for part in self])


def split_name(spec: TelemetrySpec, bucket: Column, buckets: int = BUCKETS) -> Column:
    """`train`, `val` or `test` by the bucket: two held-out shares, the rest is train."""
    held = round(buckets * spec.holdout_fraction)
    return (
        F.when(bucket < buckets - 2 * held, "train").when(bucket < buckets - held, "val").otherwise("test")
    )


def with_split(
    df: DataFrame,
    spec: TelemetrySpec,
    key: Sequence[str] | None = None,
    bucket: Column | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Add `split`. It is a function of the cycle key and the seed alone: no shuffle, no join,
    and the same members however the rows are spread. `bucket` replaces the hash.
    """
    if bucket is None:
        bucket = hash_bucket(key or spec.cycle_key, spec.seed, buckets)
    return df.withColumn("split", split_name(spec, bucket, buckets))


def split_by_cycle(
    df: DataFrame,
    spec: TelemetrySpec,
    key: Sequence[str] | None = None,
    bucket: Column | None = None,
    buckets: int = BUCKETS,
    drop: Sequence[str] | None = None,
) -> Splits:
    """The three sets without their keys (default: device, date and cycle columns)."""
    drop = [*spec.day_key, *spec.cycle_cols] if drop is None else drop
    named = with_split(df, spec, key, bucket, buckets)
    return Splits(
        *[named.where(F.col("split") == s).drop("split", *drop) for s in ("train", "val", "test")]
    )

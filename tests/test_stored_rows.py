"""Queries that read rows several times store them first."""

from datetime import datetime

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from devicepulse.workload import modelling


@pytest.fixture
def folder(spark, tmp_path):
    lines = spark.range(300).select(
        (F.col("id") % 7).alias("l_suppkey"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("l_shipdate"),
        F.when(F.col("id") % 3 == 0, "R").otherwise("N").alias("l_returnflag"),
        F.col("id").alias("l_orderkey"),
        F.lit(1).cast("bigint").alias("l_linenumber"),
        F.col("id").alias("l_partkey"),
        *[(F.pmod(F.xxhash64("id"), F.lit(n)) / 100).alias(c) for c, n in (("l_extendedprice", 9999), ("l_discount", 10), ("l_tax", 8))],
        F.pmod(F.xxhash64("id"), F.lit(50)).cast("double").alias("l_quantity"),
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    events = [(i, i % 5, datetime(2020, 1, 1 + i % 28, i % 24), "error", 1.0 * i, f'{{"k": {i}}}') for i in range(200)]
    schema = "event_id bigint, user_id bigint, ts timestamp, event_type string, value double, props string"
    spark.createDataFrame(events, schema).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_fitted_scaler_removes_duplicates_once(spark, folder, monkeypatch):
    seen, exact = [], modelling.ranking.exact_quantiles
    monkeypatch.setattr(modelling.ranking, "exact_quantiles", lambda df, *a: seen.append(plan_of(df)) or exact(df, *a))
    assert all(r.range_is_between for r in modelling.fea2_fitted_scaler(spark, folder).collect())
    assert "Window" not in seen[0] and "Exchange" not in seen[0]

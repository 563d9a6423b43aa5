import random

import pytest
from helpers import SPEC, bag, telemetry
from pyspark.sql import functions as F

from devicepulse.operators import cycles, tails


def history(seed, devices=12, days=60):
    rnd, rows = random.Random(seed), []
    for d in range(devices):
        # Some devices have long gaps, some a single day, and some begin late.
        share = rnd.choice([0.2, 0.7, 0.95, 1.0])
        begin = rnd.choice([1, 1, days // 2, days])
        rows += [(f"S{d}", n, 0, float(rnd.randint(0, 99))) for n in range(begin, days + 1) if rnd.random() < share]
    return rows


def by_parts(spark, rows, edges, spec):
    tail, out = None, None
    for low, high in zip(edges, edges[1:], strict=False):
        new = telemetry(spark, [r for r in rows if low <= r[1] < high])
        found = tails.continued(tail, new, spec)
        part = tails.new_rows_with_lags(found, spec, spec.reserved)
        out = part if out is None else out.unionByName(part)
        held = tails.latest(found, spec)
        tail = spark.createDataFrame(held.collect(), held.schema)
    return out, tail


@pytest.mark.parametrize("edges", [[1, 61], [1, 30, 61], [1, 2, 3, 4, 40, 60, 61]])
@pytest.mark.parametrize("lags", [1, 3])
def test_parts_equal_the_whole(spark, edges, lags):
    spec, rows = SPEC.with_(num_lags=lags), history(len(edges))
    got, tail = by_parts(spark, rows, edges, spec)
    whole = cycles.lag_features(cycles.with_cycles(telemetry(spark, rows), spec), spec)
    assert bag(got) == bag(whole)
    assert tail.groupBy(*spec.ids).count().agg(F.max("count")).first()[0] <= lags
    assert tail.select("serial_number").distinct().count() == len({r[0] for r in rows})


def test_devices_without_new_days_keep_their_tail(spark):
    rows = [("A", 1, 0, 1.0), ("A", 2, 0, 2.0), ("B", 1, 0, 5.0), ("A", 3, 0, 3.0), ("B", 5, 0, 6.0), ("B", 6, 0, 7.0)]
    got, _ = by_parts(spark, rows, [1, 3, 4, 5, 7], SPEC)
    assert bag(got) == bag(cycles.lag_features(cycles.with_cycles(telemetry(spark, rows), SPEC), SPEC))


@pytest.mark.parametrize("day", [1, 2])
def test_days_that_are_not_new_fail(spark, day):
    first = tails.continued(None, telemetry(spark, [("A", 1, 0, 1.0), ("A", 2, 0, 2.0)]), SPEC)
    tail = tails.latest(first, SPEC)
    late = telemetry(spark, [("A", day, 0, 9.0), ("B", 1, 0, 1.0)])
    with pytest.raises(Exception, match="not after the stored tail"):
        tails.continued(tail, late, SPEC).collect()

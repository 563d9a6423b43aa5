import pytest
from helpers import SPEC, day, plan_of, rows_of, telemetry
from pyspark.sql import functions as F

from devicepulse.operators import cycles, profiling
from devicepulse.spec import non_string_cols, numeric_cols


@pytest.fixture
def df(spark):
    return telemetry(
        spark,
        [("A", 1, 0, 1.0), ("A", 2, 1, None), ("B", 1, 0, 3.0), ("B", 4, 0, 3.0), ("C", 1, 1, None)],
    )


def by_column(profile):
    return {r.column_name: r.asDict() for r in profile.collect()}


def test_null_profile(df):
    got = by_column(profiling.null_profile(df))["smart_1_raw"]
    assert (got["null_count"], got["null_fraction"]) == (2, 0.4)


def test_null_profile_of_nothing(df):
    got = by_column(profiling.null_profile(df.limit(0)))["date"]
    assert (got["null_count"], got["null_fraction"]) == (0, None)


def test_distinct_and_constant_profiles(df):
    exact = {c: r["distinct_count"] for c, r in by_column(profiling.distinct_profile(df)).items()}
    assert exact == {"serial_number": 3, "model": 1, "date": 3, "failure": 2, "smart_1_raw": 2}
    sketch = {c: r["distinct_count"] for c, r in by_column(profiling.distinct_profile(df, True)).items()}
    assert sketch == exact
    constant = {c: r["is_constant"] for c, r in by_column(profiling.constant_profile(df)).items()}
    assert constant == {c: n < 2 for c, n in exact.items()}


def test_sketch_error_is_small(spark):
    df = spark.range(200_000).select((F.col("id") % 30_000).alias("a"))
    got = by_column(profiling.distinct_profile(df, approximate=True))["a"]["distinct_count"]
    assert abs(got - 30_000) < 0.08 * 30_000


def test_schema_profile(df):
    got = by_column(profiling.schema_profile(df))
    assert got["smart_1_raw"] == {
        "column_name": "smart_1_raw", "position": 4, "data_type": "double", "rows": 5, "non_null": 3,
    }
    assert profiling.row_count(df).first().rows == 5


def test_counts(df):
    assert rows_of(profiling.class_counts(df, SPEC)) == [(0, 3), (1, 2)]
    assert [(r.failure, r.rows, float(r.percent)) for r in profiling.class_shares(df, SPEC).orderBy("failure").collect()] == [
        (0, 3, 60.0), (1, 2, 40.0),
    ]
    assert rows_of(profiling.rows_per_device(df, SPEC), "serial_number", "rows") == [("A", 2), ("B", 2), ("C", 1)]
    assert profiling.distinct_count(df, ["serial_number", "date"]).first()[0] == 5
    assert profiling.failing_device_count(df, SPEC).first()[0] == 2
    assert rows_of(profiling.failing_devices_by(df, SPEC, ["model"])) == [("M", 2)]
    assert tuple(profiling.date_range(df, SPEC).first()) == (day(1), day(4))
    assert profiling.distinct_values(df, ["date"]).count() == 3


def test_gap_variety(df):
    gaps = cycles.day_gaps(df, SPEC)
    assert rows_of(profiling.gap_variety(gaps, SPEC), "serial_number", "gap_lengths") == [("A", 1), ("B", 1)]


def test_means_describe_and_summary(df):
    assert rows_of(profiling.class_means(df, SPEC)) == [(0, pytest.approx(7 / 3)), (1, None)]
    got = by_column(profiling.describe(df, ["smart_1_raw"]))["smart_1_raw"]
    want = {r["summary"]: r["smart_1_raw"] for r in df.describe("smart_1_raw").collect()}
    assert got["rows"] == int(want["count"])
    for ours, theirs in (("mean", "mean"), ("stddev", "stddev"), ("min", "min"), ("max", "max")):
        assert got[ours] == pytest.approx(float(want[theirs]))
    exact = by_column(profiling.summary(df, ["smart_1_raw"], exact=True))["smart_1_raw"]
    assert (exact["q25"], exact["q50"], exact["q75"]) == (2.0, 3.0, 3.0)
    sketch = by_column(profiling.summary(df, ["smart_1_raw"]))["smart_1_raw"]
    theirs = {r["summary"]: r["smart_1_raw"] for r in df.select("smart_1_raw").summary().collect()}
    assert [sketch[q] for q in ("q25", "q50", "q75")] == [float(theirs[q]) for q in ("25%", "50%", "75%")]


def test_column_choice_by_type(df):
    assert numeric_cols(df) == ["failure", "smart_1_raw"]
    assert non_string_cols(df) == ["date", "failure", "smart_1_raw"]
    assert SPEC.feature_cols(df) == ["smart_1_raw"]


def test_distinct_counts_of_every_type(spark):
    df = spark.sql("""
      SELECT id % 3 AS whole, id % 2 = 0 AS flag, CAST(id % 5 AS DECIMAL(9, 2)) AS money,
        IF(id % 2 = 0, 0.0D, -0.0D) AS zero, IF(id % 4 = 0, CAST('NaN' AS DOUBLE), 1.5D) AS nan,
        CAST(id % 7 AS STRING) AS text, CAST(CAST(id % 2 AS STRING) AS BINARY) AS bytes,
        DATE_ADD(DATE '2016-01-01', CAST(id % 6 AS INT)) AS day, TIMESTAMP_SECONDS(id % 8) AS moment,
        CAST(TIMESTAMP_SECONDS(id % 9) AS TIMESTAMP_NTZ) AS local, ARRAY(CAST(id % 2 AS STRING), ',') AS many,
        STRUCT(id % 3 AS a, 'x' AS b) AS pair, CAST(NULL AS INT) AS none, IF(id > 5, 9, NULL) AS some
      FROM range(100)""")
    exact = by_column(profiling.distinct_profile(df))
    want = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first().asDict()
    assert {c: r["distinct_count"] for c, r in exact.items()} == want
    sketch = by_column(profiling.distinct_profile(df, approximate=True))
    assert {c: r["distinct_count"] for c, r in sketch.items()} == want
    nothing = by_column(profiling.distinct_profile(df.limit(0)))
    assert {r["distinct_count"] for r in nothing.values()} == {0} and len(nothing) == len(df.columns)


def test_wide_tables(spark):
    """Profiles of 150 columns: slim rows, no row that carries all columns."""
    df = spark.range(400).select(*[(F.xxhash64("id", F.lit(i)) % (i + 2)).cast("double").alias(f"c{i}") for i in range(150)])
    profile = profiling.distinct_profile(df)
    assert "Expand" not in plan_of(profile)
    counts = {c: r["distinct_count"] for c, r in by_column(profile).items()}
    for c in ("c0", "c70", "c149"):
        assert counts[c] == df.select(c).distinct().count()
    described = by_column(profiling.describe(df))
    want = {r["summary"]: r for r in df.describe().collect()}
    for c in df.columns:
        assert described[c]["mean"] == pytest.approx(float(want["mean"][c]))
        assert described[c]["stddev"] == pytest.approx(float(want["stddev"][c]))
    assert len(by_column(profiling.null_profile(df))) == 150


def test_describing_nothing_gives_a_row_per_column(df):
    got = by_column(profiling.describe(df.limit(0)))
    assert {c: (r["rows"], r["mean"]) for c, r in got.items()} == {"failure": (0, None), "smart_1_raw": (0, None)}

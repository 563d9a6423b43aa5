import pytest
from helpers import SPEC, bag, plan_of, telemetry
from pyspark.sql import functions as F

from devicepulse.operators import cycles
from devicepulse.plans import jobs
from devicepulse.sources import Buckets, commit_table, current_version, read_current, versions, write_table
from devicepulse.spec import DEVICE_HASH


@pytest.fixture
def rows(spark):
    return telemetry(spark, [("A", 1, 0, 1.5), ("B", 2, 1, None), ("A", 2, 0, 2.5)])


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_version_replaces_the_one_before(spark, rows, tmp_path, fmt):
    folder = str(tmp_path / "t")
    assert current_version(spark, folder) is None
    commit_table(rows.limit(1), folder, fmt)
    commit_table(rows, folder, fmt, mode="overwrite")
    back = read_current(spark, folder)
    assert back.dtypes == rows.dtypes and bag(back) == bag(rows)
    assert current_version(spark, folder).number == 2


def test_a_second_first_version_is_refused(rows, tmp_path):
    commit_table(rows, str(tmp_path / "t"))
    with pytest.raises(FileExistsError):
        commit_table(rows, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="append"):
        commit_table(rows, str(tmp_path / "t"), mode="append")


def test_a_write_that_stops_halfway_leaves_the_version_and_its_types(spark, rows, tmp_path):
    folder = str(tmp_path / "t")
    commit_table(rows, folder)
    stops = F.when(F.col("serial_number") == "A", F.lit(1)).otherwise(F.raise_error(F.lit("stop")))
    with pytest.raises(Exception, match="stop"):
        commit_table(rows.repartition(3).withColumn("failure", stops.cast("string")), folder, mode="overwrite")
    assert read_current(spark, folder).dtypes == rows.dtypes and bag(read_current(spark, folder)) == bag(rows)
    assert len(versions.remove_uncommitted(spark, folder)) == 1
    assert bag(read_current(spark, folder)) == bag(rows)


def test_a_writer_that_dies_before_its_commit_is_not_seen(spark, rows, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    commit_table(rows, folder)

    def dies(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(versions._Store, "move", dies)
    with pytest.raises(KeyboardInterrupt):
        commit_table(rows.limit(1), folder, mode="overwrite")
    monkeypatch.undo()
    assert bag(read_current(spark, folder)) == bag(rows)
    # Its parts, and the commit that was not moved to its place.
    assert len(versions.remove_uncommitted(spark, folder)) == 2
    commit_table(rows.limit(1), folder, mode="overwrite")
    assert read_current(spark, folder).count() == 1


def test_of_two_writers_at_a_time_both_commit_one_after_the_other(spark, rows, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    commit_table(rows, folder)
    move, raced = versions._Store.move, []

    def move_late(self, source, target):
        if not raced:
            raced.append(target)
            commit_table(rows.limit(2), folder, mode="overwrite")
        return move(self, source, target)

    monkeypatch.setattr(versions._Store, "move", move_late)
    assert commit_table(rows.limit(1), folder, mode="overwrite").number == 3
    assert read_current(spark, folder).count() == 1


def test_a_reader_of_the_version_before_can_finish(spark, rows, tmp_path):
    folder = str(tmp_path / "t")
    commit_table(rows, folder)
    reading = read_current(spark, folder)
    commit_table(rows.limit(1), folder, mode="overwrite")
    assert reading.count() == 3
    for _ in range(3):
        commit_table(rows.limit(1), folder, mode="overwrite")
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("parts-")]) == versions.KEPT


def test_buckets_are_read_without_a_shuffle(spark, rows, tmp_path):
    folder, hashed = str(tmp_path / "t"), SPEC.hashed()
    wide = rows.union(spark.createDataFrame([(None, "M", None, 0, 1.0)], rows.schema))
    table = SPEC.with_device_hash(wide)
    commit_table(table, folder, buckets=Buckets((DEVICE_HASH,), 4, tuple(hashed.day_key)))
    back = read_current(spark, folder)
    assert bag(back) == bag(table)
    files = [p.name for p in (tmp_path / "t").glob("parts-*/part-*.parquet")]
    assert 0 < len(files) <= 4 and len({f.split("_")[-1] for f in files}) == len(files)
    assert "Exchange" not in plan_of(cycles.with_cycles(back, hashed))


def test_a_job_that_fails_leaves_the_tables_of_the_run_before(spark, tmp_path, monkeypatch):
    """The second run dies between its tables; all that the first one committed can still be used."""
    rows = [(s, d, int(d % 5 == 0), float(d * 7 % 11 + len(s))) for s in ("A", "BB", "CCC") for d in range(1, 21)]
    source, layout = str(tmp_path / "source"), jobs.Layout(str(tmp_path / "root"))
    write_table(telemetry(spark, rows), source)
    jobs.drop_duplicates_job(spark, source, layout, SPEC, fmt="parquet")
    before = bag(jobs.preprocess_job(spark, layout, SPEC))
    write, written = jobs.Layout.write, []

    def stops(self, df, name, *args, **kwargs):
        if name == "failed_rows":
            df = df.withColumn("smart_1_raw", F.raise_error(F.lit("lost")).cast("double"))
        written.append(name)
        return write(self, df, name, *args, **kwargs)

    monkeypatch.setattr(jobs.Layout, "write", stops)
    with pytest.raises(Exception, match="lost"):
        jobs.preprocess_job(spark, layout, SPEC)
    assert written == ["cleaned", "cycle_rows", "failed_cycle", "failed_rows"]
    assert bag(layout.read(spark, "training")) == before
    assert layout.read(spark, "failed_rows").count() > 0
    assert layout.schema(spark, "training") == layout.read(spark, "training").schema

"""Tables that are replaced as a whole, or not at all.

A table's folder holds a folder of parts per version, and `_commits` with a small file per committed version: where
its parts are, their types and how they are laid out. That file is written last, beside its place, and moved there
in one step that fails where another writer was first. Readers go by the newest one, so a write that stops
halfway leaves the version before it as it was, with its types.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from devicepulse.sources.tables import read_table, write_table

# Versions that are left when another is committed: the new one, and the one that readers may still be at.
KEPT = 2


@dataclass(frozen=True)
class Buckets:
    """Parts by the hash of `columns`, `n` of them, each sorted by `order`. Tables with equal buckets join on
    the columns, and windows over them run, without a shuffle."""

    columns: tuple[str, ...]
    n: int
    order: tuple[str, ...] = ()


@dataclass(frozen=True)
class Version:
    """A committed version of a table."""

    number: int
    path: str
    fmt: str
    schema: T.StructType
    buckets: Buckets | None


class _Store:
    """The file system of a path, with the session's settings."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        place = self.path(folder)
        return [f.getPath().getName() for f in self.fs.listStatus(place)] if self.fs.exists(place) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self.fs.create(self.path(path), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def move(self, source: str, target: str) -> bool:
        """Move a file in one step; False where there is one already."""
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(target).toUri(), self.conf)
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 0)
        try:
            context.rename(self.path(source), self.path(target), options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


def _commits(store: _Store, folder: str) -> list[int]:
    names = [n.removesuffix(".json") for n in store.names(f"{folder}/_commits") if n.endswith(".json")]
    return sorted(int(n) for n in names if n.isdigit())


def _commit_file(folder: str, number: int) -> str:
    return f"{folder}/_commits/{number:010d}.json"


def _version(store: _Store, folder: str, number: int) -> Version:
    held = json.loads(store.read(_commit_file(folder, number)))
    buckets = held["buckets"] and Buckets(tuple(held["buckets"]["columns"]), held["buckets"]["n"], tuple(held["buckets"]["order"]))
    return Version(number, f"{folder}/{held['parts']}", held["fmt"], T.StructType.fromJson(held["schema"]), buckets)


def current_version(spark: SparkSession, folder: str) -> Version | None:
    """The newest committed version; None where there is none."""
    folder = folder.rstrip("/")
    store = _Store(spark, folder)
    numbers = _commits(store, folder)
    return _version(store, folder, numbers[-1]) if numbers else None


def commit_table(
    df: DataFrame,
    folder: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    buckets: Buckets | None = None,
    placed: bool = False,
) -> Version:
    """Write a version of a table and commit it. `mode` is `errorifexists` or `overwrite`.

    `placed` says that `df` comes from tables with the same buckets, so its rows need not be moved again.
    Of several writers at a time the last to commit is the newest; with `errorifexists` only the first is.
    Versions before the one that was replaced are removed.
    """
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"a version is written once: no mode {mode}")
    spark, folder = df.sparkSession, folder.rstrip("/")
    store = _Store(spark, folder)
    if mode == "errorifexists" and _commits(store, folder):
        raise FileExistsError(f"{folder} exists already")
    parts = f"parts-{uuid.uuid4().hex}"
    if buckets:
        _write_buckets(df, f"{folder}/{parts}", fmt, buckets, placed)
    else:
        write_table(df, f"{folder}/{parts}", fmt, partition_by=partition_by)
    held = {
        "parts": parts,
        "fmt": fmt,
        "schema": df.schema.jsonValue(),
        "buckets": buckets and {"columns": buckets.columns, "n": buckets.n, "order": buckets.order},
    }
    beside = f"{folder}/_commits/_{parts}"
    store.write(beside, json.dumps(held))
    while True:
        numbers = _commits(store, folder)
        if numbers and mode == "errorifexists":
            store.delete(beside)
            raise FileExistsError(f"{folder} was written by another job")
        number = (numbers[-1] if numbers else 0) + 1
        if store.move(beside, _commit_file(folder, number)):
            break
    for old in numbers[: max(0, len(numbers) + 1 - KEPT)]:
        path = _version(store, folder, old).path
        # The commit goes first: what it names is there as long as it is.
        store.delete(_commit_file(folder, old))
        store.delete(path)
    return _version(store, folder, number)


def read_version(spark: SparkSession, version: Version, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of a version, with the types it was written with.

    Reading a table with buckets sets `spark.sql.requireAllClusterKeysForCoPartition` to false for the session, so
    that joins on more columns use its layout.
    """
    if version.buckets is None:
        schema = version.schema if version.fmt == "csv" else None
        return read_table(spark, version.path, version.fmt, schema, columns)
    # Joins are on more columns than the layout; by this option of the session that is enough for them.
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", False)
    # Only a table of the catalogue has buckets: an entry that points at the parts, for this session.
    name = _entry(version.path)
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in version.schema.fields)
        b = version.buckets
        order = f"SORTED BY ({_names(b.order)})" if b.order else ""
        spark.sql(
            f"CREATE TABLE {name} ({fields}) USING {version.fmt} CLUSTERED BY ({_names(b.columns)}) {order} "
            f"INTO {b.n} BUCKETS LOCATION '{version.path}'"
        )
    df = spark.table(name)
    return df if columns is None else df.select(*columns)


def read_current(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of the newest committed version."""
    version = current_version(spark, folder)
    if version is None:
        raise FileNotFoundError(f"no committed version in {folder}")
    return read_version(spark, version, columns)


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def _entry(path: str) -> str:
    return "devicepulse_" + path.rsplit("/", 1)[1].removeprefix("parts-")


def _write_buckets(df: DataFrame, path: str, fmt: str, buckets: Buckets, placed: bool) -> None:
    # The hash that deals rows to tasks is the hash of the buckets, so a task writes one file.
    rows = df if placed else df.repartition(buckets.n, *buckets.columns)
    writer = rows.write.format(fmt).bucketBy(buckets.n, *buckets.columns)
    if buckets.order:
        writer = writer.sortBy(*buckets.order)
    name = f"writing_{uuid.uuid4().hex}"
    writer.option("path", path).saveAsTable(name)
    # The parts are outside the warehouse, so they stay.
    df.sparkSession.sql(f"DROP TABLE {name}")


def remove_uncommitted(spark: SparkSession, folder: str) -> list[str]:
    """Remove what stopped writers left behind. For use while nobody writes to the table."""
    folder = folder.rstrip("/")
    store = _Store(spark, folder)
    used = {_version(store, folder, n).path.rsplit("/", 1)[1] for n in _commits(store, folder)}
    left = [f"{folder}/{n}" for n in store.names(folder) if n.startswith("parts-") and n not in used]
    left += [f"{folder}/_commits/{n}" for n in store.names(f"{folder}/_commits") if not n.endswith(".json")]
    left = [path for path in left if not path.endswith(".crc")]
    for path in left:
        store.delete(path)
    return left

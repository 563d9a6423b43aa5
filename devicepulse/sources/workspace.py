"""The shared folder that intermediate tables and checkpoints go to."""

from __future__ import annotations

import atexit
import uuid
import warnings

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"
_CLEANED: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, which every executor can reach; where none is named, a
    folder beside the tables of the warehouse, which they share as well. The same on every master.
    """
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        named = sc.getCheckpointDir() or f"{spark.conf.get(WAREHOUSE_DIR).rstrip('/')}/_shared"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder. All that a session puts there is removed when its process
    ends."""
    folder = f"{shared_folder(spark)}/devicepulse/{spark.sparkContext.applicationId}"
    if folder not in _CLEANED:
        _CLEANED.add(folder)
        atexit.register(remove, spark, folder)
    return f"{folder}/{uuid.uuid4().hex}/{name}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, if it is there and the session's JVM still is. What could not be
    deleted is told."""
    context = spark.sparkContext
    if getattr(context, "_jsc", None) is None:
        return
    try:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    except (Py4JError, AttributeError, OSError) as error:
        warnings.warn(f"{path} is left behind: {error}", stacklevel=2)


def pin(df: DataFrame) -> DataFrame:
    """Store the rows in the shared folder and go on from there.

    The lineage ends at the stored table, so a lost executor cannot change its rows; later steps
    read only the columns they need, and joins are planned by its true size.
    """
    path = scratch_path(df.sparkSession, "pinned")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)

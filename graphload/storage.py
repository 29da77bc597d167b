"""Where intermediate tables go.

Checkpoints and written intermediates must be readable by every executor, so
they live in the folder the cluster names in ``spark.checkpoint.dir``. Listing and
removing folders goes through the session's Hadoop file system, which only a
classic (not a remote) session gives access to.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session; a temporary one only in local mode."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if named:
        if current.isEmpty():
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if current.isDefined():
        return current.get().rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="graphload-")
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; never reuses an earlier run's path."""
    return f"{shared_dir(spark)}/graphload-{uuid.uuid4().hex}/{name}"


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote, if it is there."""
    files, folder = file_system(spark, path)
    files.delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and fixes the row order."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


# One thread at a time changes settings of the session and sets them back.
_LAYOUT = threading.RLock()


@contextmanager
def partitions_for(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Meanwhile shuffles have ``tasks`` partitions, if the session names fewer.

    For aggregates whose tables grow with the data: a repartition in front of them would
    cost their map-side step. The partitions are not joined again, as their compressed size
    says little about such a table. Threads wait for each other, as in ``keep_layout``.
    """
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    with _LAYOUT:
        before = [spark.conf.get(name) for name in names]
        if tasks > int(before[0]):
            for name, value in zip(names, (str(tasks), "false")):
                spark.conf.set(name, value)
        try:
            yield
        finally:
            for name, value in zip(names, before):
                spark.conf.set(name, value)


def keep_layout(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out by ``keys`` and checkpoint them so that later joins on the keys see it.

    Adaptive execution hides how the rows of a plan are laid out, so it is off meanwhile.
    Threads wait for each other, so that none takes "off" for the setting to go back to;
    another query that is planned meanwhile goes without, which changes no result.
    """
    spark = df.sparkSession
    shared_dir(spark)
    with _LAYOUT:
        before = spark.conf.get("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            return df.repartition(*keys).checkpoint()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", before)


def write_once(df: DataFrame, path: str | None = None, name: str = "table") -> DataFrame:
    """Evaluate ``df`` exactly once into a table and return the table.

    Needed where evaluating has side effects (delivery): the returned frame can
    be aggregated many times without running the writer again.
    """
    spark = df.sparkSession
    target = path or scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(target)
    return spark.read.schema(df.schema).parquet(target)

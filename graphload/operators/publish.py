"""Key/value file sets that are there whole or not at all.

Every run writes below its own id, so a second run, or one after a crash, meets nothing
of an earlier one. When all files lie there, a manifest of them is written; its commit
is the switch, as readers take the newest manifest that was written to its end. What
never got a manifest is not seen by anybody.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import file_system, remove, write_once
from .kv import write_kv

ROWS = "key binary, value binary, part int, prefix int"
MANIFEST = ("part int, prefix int, file string, rows bigint, bytes bigint, first_key binary, "
            "last_key binary")
# A list of files is broadcast up to so many (some 30 MB); beyond it Spark joins by shuffle.
FILES_TO_BROADCAST = 100_000


@dataclass(frozen=True)
class FileSet:
    """One publication: the run that wrote the files, their folder and their manifest."""

    at: int
    run: str
    data: str
    manifest: str


def new_run() -> str:
    return f"{time.strftime('%Y%m%d%H%M%S')}-{uuid.uuid4().hex[:8]}"


def read_files(spark: SparkSession, data: str) -> DataFrame:
    return spark.read.schema(ROWS).parquet(data)


def file_manifest(spark: SparkSession, data: str) -> DataFrame:
    """(part, prefix, file, rows, bytes, first_key, last_key) of sorted files below ``data``.

    Rows are counted from file metadata alone. The keys are read once and only the first
    and the last of a file go on; nothing is sorted.
    """
    rows = read_files(spark, data)
    name = F.col("_metadata.file_path")
    files = rows.select("part", "prefix", name.alias("path"), F.col("_metadata.file_size").alias(
        "bytes")).groupBy("part", "prefix", "path", "bytes").agg(F.count(F.lit(1)).alias("rows"))
    files = write_once(files, name="files")
    places = rows.select(name.alias("path"), F.col("_metadata.row_index").alias("place"), "key")
    ends = files.select("path", "rows")
    few = files.count() <= FILES_TO_BROADCAST
    found = places.join(F.broadcast(ends) if few else ends, "path").filter(
        (F.col("place") == 0) | (F.col("place") == F.col("rows") - 1))
    keys = found.groupBy("path").agg(F.min("key").alias("first_key"),
                                     F.max("key").alias("last_key"))
    inside = F.regexp_extract("path", r"(part=\d+/prefix=\d+/[^/]+)$", 1)
    return files.join(keys, "path").select("part", "prefix", inside.alias("file"), "rows", "bytes",
                                           "first_key", "last_key")


def sets_of(spark: SparkSession, path: str) -> list[FileSet]:
    """All publications below ``path``, oldest first."""
    files, folder = file_system(spark, path)
    if not files.exists(folder):
        return []
    found = []
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("published=") and files.exists(
                file_system(spark, f"{path}/{name}/_SUCCESS")[1]):
            at, run = name.removeprefix("published=").split("-", 1)
            found.append(FileSet(int(at), run, f"{path}/run={run}", f"{path}/{name}"))
    return sorted(found, key=lambda s: s.at)


def current_set(spark: SparkSession, path: str) -> FileSet | None:
    return max(sets_of(spark, path), key=lambda s: s.at, default=None)


def publish_kv(kv: DataFrame, path: str, run: str | None = None, files: int | None = None
               ) -> FileSet:
    """Write a whole set of sorted files and make it the current one.

    A run that is made again under its id writes its files anew. Earlier sets stay until
    ``retire``, so readers that hold one go on.
    """
    spark, run = kv.sparkSession, run or new_run()
    data = f"{path}/run={run}"
    write_kv(kv, data, files, mode="overwrite")
    manifest = file_manifest(spark, data)
    at = max([time.time_ns(), *(s.at + 1 for s in sets_of(spark, path))])
    target = f"{path}/published={at}-{run}"
    manifest.write.parquet(target)
    return FileSet(at, run, data, target)


def read_kv(spark: SparkSession, path: str) -> DataFrame:
    """(part, prefix, key, value) of the current set."""
    now = current_set(spark, path)
    if now is None:
        raise FileNotFoundError(f"nothing was published below {path}")
    return read_files(spark, now.data).select("part", "prefix", "key", "value")


def read_manifest(spark: SparkSession, found: FileSet) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(found.manifest)


def set_problems(spark: SparkSession, found: FileSet) -> DataFrame:
    """(file, problem) where a set is not what its manifest says; empty for a whole set.

    Files may be missing, added or changed (other rows or keys, some out of order), and
    those of one part must not overlap.
    """
    # one row for each file, looked at twice: the keys are read once
    said, there = read_manifest(spark, found), write_once(file_manifest(spark, found.data),
                                                          name="there")
    both = said.select("file", F.struct("rows", "bytes", "first_key", "last_key").alias("said")).join(
        there.select("file", F.struct("rows", "bytes", "first_key", "last_key").alias("there")),
        "file", "full")
    differing = both.filter(~F.col("said").eqNullSafe(F.col("there"))).select(
        "file", F.when(F.col("there").isNull(), "missing").when(
            F.col("said").isNull(), "added").otherwise("changed").alias("problem"))
    # one row for each file, dealt out by part
    before = F.max("last_key").over(Window.partitionBy("part", "prefix").orderBy(
        "first_key", "file").rowsBetween(Window.unboundedPreceding, -1))
    overlapping = there.withColumn("before", before).filter("before >= first_key").select(
        "file", F.lit("overlaps").alias("problem"))
    return differing.unionByName(overlapping)


def retire(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove all but the newest ``keep`` sets; returns the runs that went.

    Runs that were never published stay: they may be at work.
    """
    if keep < 1:
        raise ValueError("the current set stays")
    old = sets_of(spark, path)[:-keep]
    kept = {s.run for s in sets_of(spark, path)[-keep:]}
    for found in old:
        # the manifest first, so that no set is seen without its files
        remove(spark, found.manifest)
        if found.run not in kept:
            remove(spark, found.data)
    return [s.run for s in old]

"""Line dedup over levelled sorted runs of line hashes. Native DataFrame functions only.

The index is a set of runs: tables of (hash of a line, documents counted, holder), dealt
into buckets by the hash and sorted inside. A new batch of documents is aggregated to
one row for each hash and merge-joined with every run: the runs lie in their buckets,
so only the batch is shuffled. Hashes that no run has (the anti-join) name the batch's
document as holder of the line, the others only add to the count; both become the
batch's own run. When a level has ``fanout`` runs they are merged into one of the next,
so a batch meets at most fanout - 1 runs a level and a hash is rewritten once a level.

A run's folder is named after the batches it covers. A run inside another's range is
what a merge that died before its cleaning up left behind; opening the index skips it.
"""

from __future__ import annotations

import string
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import file_system, remove, scratch_path
from .common import settled, table

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 8
FANOUT = 4

# Fixed value: the blanks that are stripped, space and the ASCII controls 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"

HASH = ["a", "b"]
_RUN = "a bigint, b bigint, n bigint, top {id}"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased."""
    stripped = F.btrim(line, F.lit(BLANKS))
    # where all characters are ASCII the built-in does the same and is far quicker
    ascii_only = F.octet_length(stripped) == F.length(stripped)
    return F.when(ascii_only, F.lower(stripped)).otherwise(
        F.translate(stripped, string.ascii_uppercase, string.ascii_lowercase))


def text_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text hash, place, a, b) of every line whose key has ``min_chars`` or more."""
    text = F.coalesce("text", F.lit(""))
    lines = docs.select("doc_id", F.xxhash64(text).alias("text_hash"),
                        F.posexplode(F.split(text, "\n")).alias("place", "line"))
    keyed = lines.withColumn("key", line_key(F.col("line"))).filter(F.length("key") >= min_chars)
    return keyed.select("doc_id", "text_hash", "place", F.xxhash64("key").alias("a"),
                        F.xxhash64(F.lit(1), "key").alias("b"))


def count_keys(lines: DataFrame, *by: str) -> DataFrame:
    """(by, a, b, n, top): documents with the line, and the largest doc_id among them."""
    return (lines.select(*by, "doc_id", *HASH).distinct().groupBy(*by, *HASH)
            .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("top")))


def _buckets(spark: SparkSession) -> int:
    """As many as shuffle partitions, so that a batch meets the runs without another shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class LineRuns:
    """An index in a shared folder; ``path`` names one that is to be kept and opened again."""

    def __init__(self, spark: SparkSession, path: str | None = None, id_type: str = "bigint",
                 fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("a level needs two runs or more to merge")
        self.spark, self.fanout = spark, fanout
        self.path = path or scratch_path(spark, "runs")
        self.schema = _RUN.format(id=id_type)
        # (first batch, last batch) -> (name of the table, its folder)
        self.runs: dict[tuple[int, int], tuple[str, str]] = {}
        # runs that are parts of others; ``clean`` removes them
        self.merged: list[tuple[str, str]] = []
        found = self._stored()
        for first, last, buckets in found:
            covered = any(f <= first and last <= t and (f, t) != (first, last)
                          for f, t, _ in found)
            self._open(first, last, buckets)
            if covered:
                self.merged.append(self.runs.pop((first, last)))

    def _stored(self) -> list[tuple[int, int, int]]:
        files, folder = file_system(self.spark, self.path)
        if not files.exists(folder):
            return []
        names = [e.getPath().getName() for e in files.listStatus(folder)
                 if files.exists(file_system(self.spark, f"{e.getPath()}/_SUCCESS")[1])]
        return [tuple(map(int, n.removeprefix("run-").split("-"))) for n in names]

    def _folder(self, first: int, last: int, buckets: int) -> str:
        return f"{self.path}/run-{first}-{last}-{buckets}"

    def _open(self, first: int, last: int, buckets: int) -> None:
        name, folder = f"graphload_run_{uuid.uuid4().hex}", self._folder(first, last, buckets)
        self.spark.sql(
            f"CREATE TABLE {name} ({self.schema}) USING parquet CLUSTERED BY (a, b) "
            f"SORTED BY (a, b) INTO {buckets} BUCKETS LOCATION '{folder}'")
        self.runs[first, last] = name, folder

    def _write(self, rows: DataFrame, first: int, last: int) -> None:
        """A run of the batches first..last, a file for each bucket."""
        buckets = _buckets(self.spark)
        name, folder = f"graphload_new_{uuid.uuid4().hex}", self._folder(first, last, buckets)
        # what an attempt that died left there has no _SUCCESS; a whole run is never rewritten
        remove(self.spark, folder)
        (rows.select(*HASH, "n", "top").write.bucketBy(buckets, *HASH).sortBy(*HASH)
         .option("path", folder).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")
        self._open(first, last, buckets)

    def clean(self) -> None:
        """Remove the runs that were merged into others, with all frames over them."""
        for name, folder in self.merged:
            self.spark.sql(f"DROP TABLE {name}")
            remove(self.spark, folder)
        self.merged = []

    def close(self) -> None:
        """Take the tables out of the session's catalog; the files of whole runs stay."""
        self.clean()
        for name, _ in self.runs.values():
            self.spark.sql(f"DROP TABLE {name}")
        self.runs = {}

    def add(self, keys: DataFrame) -> DataFrame:
        """Add a batch's (a, b, n, top); returns the (a, b, top) that no earlier batch had."""
        batch = max((last for _, last in self.runs), default=-1) + 1
        marked, known = keys.select(*HASH, "n", "top"), F.lit(False)
        for i, (name, _) in enumerate(self.runs.values()):
            run = self.spark.table(name).select(*HASH, F.lit(True).alias(f"in{i}"))
            marked = marked.join(run, HASH, "left")
            known = known | F.col(f"in{i}").isNotNull()
        self._write(marked.withColumn("top", F.when(~known, F.col("top"))), batch, batch)
        own = self.spark.table(self.runs[batch, batch][0])
        self._compact()
        return own.filter(F.col("top").isNotNull()).select(*HASH, "top")

    def _compact(self) -> None:
        """Merge the newest ``fanout`` runs as long as they are of one width."""
        while True:
            newest = sorted(self.runs)[-self.fanout:]
            widths = {last - first for first, last in newest}
            if len(newest) < self.fanout or len(widths) > 1:
                return
            self._write(self._merged(newest), newest[0][0], newest[-1][1])
            self.merged += [self.runs.pop(run) for run in newest]

    def _merged(self, runs: list[tuple[int, int]]) -> DataFrame:
        # read as plain files: Spark 4.1 takes a union of bucketed tables for dealt out by
        # the hash when it is not, and would leave a row of each run
        folders = [self.runs[run][1] for run in runs]
        return self.spark.read.schema(self.schema).parquet(*folders).groupBy(*HASH).agg(
            F.sum("n").alias("n"), F.max("top").alias("top"))

    def totals(self) -> DataFrame:
        """(a, b, n, top) over all batches."""
        return self._merged(sorted(self.runs))


def without_lines(docs: DataFrame, lines: DataFrame, dropped: Column) -> DataFrame:
    """``docs`` without the ``lines`` (of ``text_lines``, with more columns) that are dropped.

    Adds n_lines and n_dropped; the other lines stay, joined by line ends, and a text that
    loses nothing stays as it is, null included. Columns with those names are replaced. The
    places of a text come together in one row, as its lines do.
    """
    gone = lines.filter(dropped).groupBy(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(
        F.collect_set("place").alias("__gone"))
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    text = F.coalesce("text", F.lit(""))
    # split before the join, so that the lines are a column and not cut again for each place
    split = docs.select(*[F.col(f"`{c}`") for c in kept], F.split(text, "\n").alias("__lines"),
                        F.xxhash64(text).alias("__own"))
    joined = split.join(gone, F.col("doc_id").eqNullSafe(F.col("__id"))
                        & (F.col("__own") == F.col("__hash")), "left")
    places = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    left = F.array_join(F.transform(places, lambda i: F.col("__lines")[i]), "\n")
    return joined.select(
        *[F.when(F.col("__gone").isNull(), F.col("text")).otherwise(left).alias(c)
          if c == "text" else F.col(f"`{c}`") for c in kept],
        F.size("__lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"))


def drop_seen(docs: DataFrame, runs: LineRuns, min_chars: int = MIN_CHARS) -> DataFrame:
    """A new batch of documents without the lines that a batch before it had.

    Of a line that is new with this batch, the largest doc_id that holds it keeps it. The
    batch's lines are in the index afterwards. Other columns, nulls, empty texts and
    repeated rows: as for ``without_lines`` and ``drop_frequent``.
    """
    lines = settled(text_lines(docs, min_chars))
    fresh = settled(runs.add(count_keys(lines)).withColumnRenamed("top", "holder"))
    marked = lines.join(fresh, HASH, "left")
    return without_lines(docs, marked, ~F.coalesce(F.col("doc_id") == F.col("holder"),
                                                   F.lit(False)))


def drop_frequent(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                  batches: int = BATCHES) -> DataFrame:
    """``docs`` where a frequent line stays in the largest doc_id that holds it only.

    Lines are compared by their keys; those of ``min_chars`` code points or more that are in
    ``min_docs`` documents or more go elsewhere, all copies of them. doc_ids are numbers; the
    batches are ranges of them, the largest first, so that the first batch that has a line
    holds its keeper. Rows of one doc_id are one document; a null doc_id is a document
    smaller than all others. A null or empty text is one empty line. Adds n_lines and
    n_dropped; an empty table gives no rows. Columns with those names are replaced.
    """
    spark = docs.sparkSession
    lines = settled(text_lines(docs, min_chars))
    shares = [i / batches for i in range(1, batches)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares)).first()[0] or []
    batch = reduce(Column.__add__, [F.coalesce(F.col("doc_id") <= b, F.lit(True)).cast("int")
                                    for b in sorted(set(bounds))], F.lit(0))
    keys = write_batches(count_keys(lines.withColumn("batch", batch), "batch"))
    runs = LineRuns(spark, id_type=docs.schema["doc_id"].dataType.simpleString())
    for number in range(len(set(bounds)) + 1):
        runs.add(keys.filter(F.col("batch") == number))
        runs.clean()
    frequent = settled(runs.totals().filter(F.col("n") >= min_docs).select(
        *HASH, F.col("top").alias("holder")))
    runs.close()
    marked = lines.join(frequent, HASH)
    return without_lines(docs, marked, ~F.col("doc_id").eqNullSafe(F.col("holder")))


def write_batches(keys: DataFrame) -> DataFrame:
    """``keys`` written with a folder for each batch."""
    path = scratch_path(keys.sparkSession, "batches")
    keys.write.partitionBy("batch").parquet(path)
    return keys.sparkSession.read.schema(keys.schema).parquet(path)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines that five or more documents share."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_frequent(docs).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
lines AS (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split),
keyed AS (
  SELECT r, doc_id, line, place, translate(
           trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.r, k.doc_id, k.line, k.place,
         f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.holder AS gone
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

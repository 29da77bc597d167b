"""Min-cost-flow resharding: move the fewest bytes from old shards to new capacities.

Spark sums the bytes of hash blocks inside every old shard (at most shards x blocks
rows, whatever the data), the driver solves the flow between old and new shards and
deals whole blocks along it, and the small block plan goes back as a broadcast of
that proven size. Rows are numbered inside (shard, block), never inside a shard.
Whole rows move once: a block's new shard is known before the shuffle, which deals
them out as they are written.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..storage import remove, scratch_path
from .common import table

SHARDS = 16
BLOCKS = 1024
# Tasks that number and write the rows of one new shard, at most.
SLICES = 32
# Old and new files lie side by side until the job is done.
COMPRESSION = "zstd"


def min_cost_flow(old: Sequence[int], capacity: Sequence[int]) -> list[dict[int, int]]:
    """How many bytes each old shard sends to each new one.

    Staying in the shard of the same number costs nothing, moving costs one for
    every byte. Successive shortest paths with potentials over the two-sided graph;
    the sum of the capacities must be at least the sum of the sizes.
    """
    if sum(capacity) < sum(old):
        raise ValueError("the new shards have no room for all bytes")
    n, m = len(old), len(capacity)
    source, sink, nodes = n + m, n + m + 1, n + m + 2
    graph: list[list[int]] = [[] for _ in range(nodes)]
    to, room, cost = [], [], []

    def arc(a: int, b: int, most: int, price: int) -> None:
        for x, y, r, p in ((a, b, most, price), (b, a, 0, -price)):
            graph[x].append(len(to))
            to.append(y), room.append(r), cost.append(p)

    for i, size in enumerate(old):
        arc(source, i, size, 0)
    flows = {}
    for i, size in enumerate(old):
        for j in range(m):
            flows[i, j] = len(to)
            arc(i, n + j, size, int(i != j))
    for j, most in enumerate(capacity):
        arc(n + j, sink, most, 0)
    potential = [0] * nodes
    left = sum(old)
    while left:
        far: list[float] = [float("inf")] * nodes
        far[source], came, heap = 0, [-1] * nodes, [(0, source)]
        while heap:
            d, x = heapq.heappop(heap)
            if d > far[x]:
                continue
            for e in graph[x]:
                reach = d + cost[e] + potential[x] - potential[to[e]]
                if room[e] and reach < far[to[e]]:
                    far[to[e]], came[to[e]] = reach, e
                    heapq.heappush(heap, (reach, to[e]))
        potential = [p + (d if d < float("inf") else 0) for p, d in zip(potential, far)]
        path, x = [], sink
        while x != source:
            path.append(came[x])
            x = to[came[x] ^ 1]
        sent = min(left, *(room[e] for e in path))
        for e in path:
            room[e] -= sent
            room[e ^ 1] += sent
        left -= sent
    return [{j: room[flows[i, j] ^ 1] for j in range(m) if room[flows[i, j] ^ 1]}
            for i in range(n)]


def deal_blocks(blocks: Sequence[tuple[int, int, int, int]], shards: int
                ) -> list[tuple[int, int, int, int]]:
    """(old shard, block, new shard, first slot) of each (old shard, block, bytes, rows).

    Large blocks first, each to the open transfer of its shard that has most bytes
    left, so that the smallest blocks even out what is left over.
    """
    old = [0] * (max((b[0] for b in blocks), default=-1) + 1)
    for shard, _, size, _ in blocks:
        old[shard] += size
    total = sum(old)
    capacity = [int(Fraction(total * (j + 1), shards)) - int(Fraction(total * j, shards))
                for j in range(shards)]
    need = min_cost_flow(old, capacity)
    # what a transfer gets above its bytes is taken from the other transfers into that shard
    over = [0] * shards
    placed = []
    for shard, block, size, rows in sorted(blocks, key=lambda b: (-b[2], b[0], b[1])):
        goal = max(need[shard], key=lambda j: (need[shard][j] - over[j], j == shard, -j))
        need[shard][goal] -= size
        if need[shard][goal] < 0:
            over[goal] -= need[shard][goal]
            need[shard][goal] = 0
        placed.append((goal, shard, block, rows))
    plan, used = [], [0] * shards
    for goal, shard, block, rows in sorted(placed):
        plan.append((shard, block, goal, used[goal]))
        used[goal] += rows
    return plan


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus 1; a null text has no bytes."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _marked(rows: DataFrame, old: Column, size: Column, key: list[Column], blocks: int
            ) -> DataFrame:
    return (rows.withColumn("old_shard", old.cast("int")).withColumn("__size", size)
            .withColumn("__block", F.pmod(F.xxhash64(*key), F.lit(blocks)).cast("int")))


def _block_plan(marked: DataFrame, shards: int) -> list[tuple[int, int, int, int]]:
    sums = marked.groupBy("old_shard", "__block").agg(F.sum("__size"), F.count(F.lit(1)))
    return deal_blocks([tuple(r) for r in sums.collect()], shards)


def _placed(marked: DataFrame, plan: list[tuple[int, int, int, int]], key: list[Column]
            ) -> DataFrame:
    """Rows with shard and slot, dealt out by shard and slice: one shuffle, one sort."""
    moves = marked.sparkSession.createDataFrame(
        plan, "old_shard int, __block int, shard int, __first long")
    place = F.row_number().over(Window.partitionBy(
        "shard", "__slice", "old_shard", "__block").orderBy(*key, "__size"))
    return (marked.drop("shard").join(F.broadcast(moves), ["old_shard", "__block"])
            .withColumn("__slice", F.col("__block") % SLICES).repartition("shard", "__slice")
            .withColumn("slot", F.col("__first") + place - 1)
            .drop("__block", "__slice", "__size", "__first"))


def reshard(rows: DataFrame, old: Column, size: Column, key: list[Column], shards: int = SHARDS,
            blocks: int = BLOCKS) -> DataFrame:
    """``rows`` with old_shard, shard and slot.

    ``old`` is the shard each row is in now (0 and up), ``size`` its bytes. ``key``
    decides the block of a row and the order inside; rows alike in all of it are
    interchangeable. An empty table gives no rows. Columns of ``rows`` with those
    names are replaced. Nulls in ``key`` are a value like others (a null doc_id sorts
    first), and a null text has the size that ``size`` gives it.
    """
    marked = _marked(rows, old, size, key, blocks)
    return _placed(marked, _block_plan(marked, shards), key)


def affected_shards(resharded: DataFrame) -> list[int]:
    """Shards that a row leaves or enters; the others keep their files."""
    moved = resharded.filter("old_shard <> shard")
    pairs = moved.select("old_shard", "shard").distinct().collect()
    return sorted({s for pair in pairs for s in pair})


def _write_shards(rows: DataFrame, path: str) -> None:
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard")
     .parquet(path, compression=COMPRESSION))


def rewrite_affected(resharded: DataFrame, path: str) -> list[int]:
    """Write the affected shards as ``path/shard=N``; returns them.

    Run it on a table that is cut off from the old files (a checkpoint), with
    ``path`` a new folder or one whose other shards shall stay as they are. The folder
    of a shard that all rows leave goes.
    """
    changed = affected_shards(resharded)
    left = resharded.filter(F.col("shard").isin(changed))
    _write_shards(left.drop("old_shard").repartition("shard", F.pmod(F.col("slot"), F.lit(8))),
                  path)
    # one row for each shard
    filled = {r["shard"] for r in left.select("shard").distinct().collect()}
    for shard in set(changed) - filled:
        remove(resharded.sparkSession, f"{path}/shard={shard}")
    return changed


def reshard_files(rows: DataFrame, path: str, old: Column, size: Column, key: list[Column],
                  shards: int = SHARDS, blocks: int = BLOCKS) -> tuple[DataFrame, list[int]]:
    """(rows as the shards below ``path`` have them, shards that were written again).

    ``rows``, with all their columns, are laid out as ``path/shard=N`` by ``old``, resharded
    as ``reshard`` does, and the affected shards written anew; what comes back is read from
    those files, and for the shards that kept theirs from the plan, which numbers their rows.
    Old files go only when all new ones are written, so they are read while those are made.
    """
    spark = rows.sparkSession
    rows.withColumn("shard", old.cast("int")).write.partitionBy("shard").parquet(
        path, compression=COMPRESSION)
    kinds = StructType([*[f for f in rows.schema if f.name != "shard"],
                        StructField("shard", IntegerType())])
    marked = _marked(spark.read.schema(kinds).parquet(path), F.col("shard"), size, key, blocks)
    plan = _block_plan(marked, shards)
    before, after = {shard for shard, *_ in plan}, {goal for _, _, goal, _ in plan}
    changed = sorted({s for shard, _, goal, _ in plan if shard != goal for s in (shard, goal)})
    placed = _placed(marked, plan, key)
    columns = [*[c for c in rows.columns if c not in ("shard", "slot")], "shard", "slot"]
    if changed:
        # a row in an affected shard comes from one, so the others are not read
        _write_shards(placed.filter(F.col("old_shard").isin(changed)).select(*columns), path)
    for shard in set(changed) - after:
        remove(spark, f"{path}/shard={shard}")
    kinds = StructType([placed.schema[c] for c in columns])
    written = spark.read.schema(kinds).parquet(path).filter(F.col("shard").isin(changed))
    found = written.select(*columns)
    if not before <= set(changed):
        found = found.unionByName(
            placed.filter(~F.col("old_shard").isin(changed)).select(*columns))
    return found, changed


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lie by source in 16 uneven shards, evened out in bytes; whole documents
    are moved, and what is returned is read from the shards they came to lie in."""
    docs = table(spark, sf_dir, "documents")
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    old = F.pmod(F.crc32(F.encode(F.coalesce("source", F.lit("")), "UTF-8")), F.lit(SHARDS))
    size = text_size(F.col("text"))
    placed, _ = reshard_files(docs, scratch_path(spark, "shards"), old, size,
                              [F.col("doc_id"), crc])
    return placed.select("doc_id", size.alias("size"), crc.alias("text_crc32"),
                         F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"),
                         F.lit(None).cast("int").alias("grown_shard"),
                         old.cast("int").alias("old_shard"))

"""Peer-pressure clustering: vertices adopt the label most of their in-neighbours vote for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import cut_lineage, keep_layout, partitions_for, write_once

# A source with more than 1/HOT_SHARE of all edges is hot, so at most
# HOT_SHARE sources are: the list of hot sources is always small.
HOT_SHARE = 200
# Edges that a task joins and whose votes it counts, some 250 MB.
EDGES_PER_TASK = 1_000_000


class NotConverged(RuntimeError):
    """Labels still changed in the last round that was allowed."""


def _laid_out(edges: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    """Edges with a weight and a salt (0 unless the source is hot), and the hot sources.

    Parallel edges are one edge with their number as weight. The edges are dealt out
    by (src, salt) once; the checkpoint keeps that layout, so no round moves them.
    """
    weighted = write_once(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight")),
                          name="weighted")
    degrees = weighted.groupBy("src").agg(F.count(F.lit(1)).alias("__out"))
    limit = (degrees.agg(F.sum("__out")).first()[0] or 0) / HOT_SHARE
    hot = write_once(degrees.filter(F.col("__out") > limit).select("src"), name="hot")
    marked = hot.withColumn("__hot", F.lit(True))
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64("dst"), F.lit(salts))).otherwise(0)
    salted = weighted.join(F.broadcast(marked), "src", "left").select(
        "src", "dst", "weight", salt.cast("int").alias("salt"))
    return keep_layout(salted, "src", "salt"), marked


def _round(labels: DataFrame, edges: DataFrame, hot: DataFrame, salts: int) -> DataFrame:
    """One vote: (id, label, old). A vertex counts its own label; ties go to the smaller."""
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0)))
    voters = (labels.join(F.broadcast(hot), labels["id"] == hot["src"], "left")
              .select(labels["id"].alias("src"), "label", F.explode(copies).alias("salt")))
    votes = edges.join(voters, ["src", "salt"]).select(
        F.col("dst").alias("id"), "label", "weight", F.lit(False).alias("own"))
    votes = votes.unionByName(labels.select("id", "label", F.lit(1).cast("bigint").alias("weight"),
                                            F.lit(True).alias("own")))
    # counted per (vertex, label) with a map-side step before any vertex is gathered
    tally = votes.groupBy("id", "label").agg(F.sum("weight").alias("n"), F.max("own").alias("own"))
    best = F.min(F.struct((-F.col("n")).alias("less"), "label"))
    decided = tally.groupBy("id").agg(best["label"].alias("label"),
                                      F.max(F.when(F.col("own"), F.col("label"))).alias("old"))
    # votes for ends that are no vertices have no old label
    return decided.filter(F.col("old").isNotNull())


def peer_pressure(vertices: DataFrame, edges: DataFrame, max_iter: int = 30, salts: int = 16,
                  partial: bool = False) -> DataFrame:
    """(id, label) when a round changes no label.

    ``vertices`` has ``id``; ``edges`` has ``src`` and ``dst``. Labels that still change
    after ``max_iter`` rounds raise NotConverged, or are returned as they are if
    ``partial`` results are asked for.
    """
    edges = edges.select("src", "dst")
    # one pass without columns, so that the number of tasks and not their size grows
    with partitions_for(edges.sparkSession, -(-edges.count() // EDGES_PER_TASK)):
        ids = vertices.select("id").filter(F.col("id").isNotNull()).distinct()
        labels = cut_lineage(ids.withColumn("label", F.col("id")))
        edges, hot = _laid_out(edges, salts)
        for _ in range(max_iter):
            # a written table forgets the constraints of its plan, which would grow by round
            voted = write_once(_round(labels, edges, hot, salts), name="round")
            labels = voted.select("id", "label")
            if voted.filter("label <> old").isEmpty():
                return labels
    if not partial:
        raise NotConverged(f"labels still change after {max_iter} rounds")
    return labels


def cluster_count(labels: DataFrame) -> DataFrame:
    return labels.select("label").distinct().agg(F.count(F.lit(1)).alias("clusters"))

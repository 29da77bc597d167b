"""URL filters: rules first, then trust and distrust spread over the links of hosts.

Trust flows along links from the hosts that rules allow; distrust flows against
them from the hosts that rules block (who links to a blocked host is suspect).
Both are personalised PageRank over host edges that are summed per pair of hosts
before any join. A host is blocked when distrust is more than ``threshold`` of the
sum of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settled, table

# The rules of the contract, (rule, verdict).
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
ROUNDS = 30
CLOSE = 1e-6
THRESHOLD = 0.5


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule whose host is the host or above it and whose path starts the path."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = (host == name) | host.endswith("." + name)
        found = F.when(fits & path.startswith(slash + rest), F.lit(rule)).otherwise(found)
    return found


def link_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links): links between different hosts, summed; relative links stay at home."""
    links = F.regexp_extract_all("html", F.lit(
        "(?is)<a\\s[^>]*?href\\s*=\\s*[\"']?\\s*((?:[a-z][a-z0-9+.-]*:)?//[^\"'\\s>]*)"), 1)
    linked = (pages.filter(F.col("html").contains("//"))
              .select(host_of(F.col("url")).alias("src"), F.explode(links).alias("to")))
    to = F.when(F.col("to").startswith("//"), F.concat(F.lit("x:"), "to")).otherwise(F.col("to"))
    return (linked.select("src", host_of(to).alias("dst"))
            .filter("src <> '' and dst <> '' and src <> dst")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links")))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS,
           close: float = CLOSE) -> DataFrame:
    """(kind, host, score): personalised PageRank of every kind of seed over its own edges.

    ``edges`` (kind, src, dst, share): shares of a source sum to 1. ``seeds`` (kind,
    host, start): starts of a kind sum to 1. Hosts without links out give what they
    have back to the seeds of their kind. Stops when no score moved more than
    ``close``, or raises after ``rounds`` times more than it can need.
    """
    scores = settled(seeds.select("kind", "host", F.col("start").alias("score")))
    has_out = settled(edges.groupBy("kind", "src").agg(F.lit(True).alias("out")))
    edges = settled(edges)
    if edges.isEmpty():
        return scores
    moved, done = float("inf"), 0
    # the change shrinks at least by the damping in every round
    while moved > close and done < 10 * rounds:
        done += 1
        given = scores.withColumnRenamed("host", "src")
        flow = (edges.join(given, ["kind", "src"])
                .select("kind", F.col("dst").alias("host"),
                        (F.col("score") * F.col("share") * damping).alias("part")))
        lost = (given.join(has_out, ["kind", "src"], "left").groupBy("kind")
                .agg(F.sum(F.when(F.col("out").isNull(), F.col("score")).otherwise(0.0))
                     .alias("lost")))
        home = seeds.join(F.broadcast(lost), "kind", "left").select(
            "kind", "host", (F.col("start") * (
                1 - damping + damping * F.coalesce("lost", F.lit(0.0)))).alias("part"))
        fresh = flow.unionByName(home).groupBy("kind", "host").agg(F.sum("part").alias("score"))
        step = settled(fresh.join(
            scores.withColumnRenamed("score", "old"), ["kind", "host"], "left"))
        moved = step.agg(F.max(F.abs(F.col("score") - F.coalesce("old", F.lit(0.0))))).first()[0]
        scores = step.select("kind", "host", "score")
        moved = moved or 0.0
    if moved > close:
        raise RuntimeError("the scores of hosts did not settle")
    return scores


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page.

    A url that is null or has no :// has an empty host and path and takes no part
    in the graph; it is allowed, like every host that neither trust nor distrust
    reaches. A null html has no links. Repeated rows are judged each and count
    each as seeds. Extra columns are left out.
    """
    verdicts = dict(rules)
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"),
                          path_of(F.col("url")).alias("path"))
    ruled = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    given = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for r, v in verdicts.items()],
                       F.lit(None).cast("string"))
    ruled = ruled.withColumn("given", given)
    counts = settled(ruled.filter("given is not null and host <> ''").groupBy("given", "host")
                         .agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy("given").agg(F.sum("n").alias("total"))
    kind = F.when(F.col("given") == "allow", F.lit("trust")).otherwise(F.lit("distrust"))
    seeds = settled(counts.join(F.broadcast(totals), "given").select(
        kind.alias("kind"), "host", (F.col("n") / F.col("total")).alias("start")))
    links = settled(link_edges(pages))
    forward = links.select(F.lit("trust").alias("kind"), "src", "dst", "links")
    backward = links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"),
                            F.col("src").alias("dst"), "links")
    both = forward.unionByName(backward)
    out = both.groupBy("kind", "src").agg(F.sum("links").alias("out"))
    edges = both.join(out, ["kind", "src"]).select("kind", "src", "dst",
                                                   (F.col("links") / F.col("out")).alias("share"))
    scores = spread(edges, seeds)
    hosts = scores.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"))
    hosts = settled(hosts)
    bad = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    verdict = F.coalesce("given", F.when(bad, F.lit("block")).otherwise(F.lit("allow")))
    return ruled.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"))

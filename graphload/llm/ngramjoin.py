"""N-gram Jaccard join over a count-vector R-tree.

Equal shingle sets are one class. Sets that overlap enough must share a shingle
among the first few of each in any one order of all shingles, so classes meet in
buckets of such shingles (frequent ones come last in the order; which ones they are
is fitted on a bounded sample of ``SAMPLE`` documents, and any order finds all links). In a bucket every
class is a point: its shingles hashed into ``GROUPS`` groups (more for large sets), counted. The points
are packed into an R-tree, and the sum of the smaller coordinates of two boxes
bounds the overlap of all pairs inside; what survives is verified on whole sets.

Only links between classes not yet connected matter, so buckets link their members
to one pivot first, then to another. Buckets that still hold several components form
neighbourhoods, and those are searched whole, with their sets, for links across
components. Buckets above ``BUCKET`` classes (neighbourhoods above ``HOOD``) are cut into
blocks, one task a pair of blocks; no pairs are written but those of the pivots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import keep_layout, remove, scratch_path, write_once
from .common import (
    block_pairs, components, grouped_batches, grouped_chunks, local_components, settled,
    small_slices, table, text_buffer,
)

WORDS = 4
PERCENT = 85
GROUPS = 64
FILL = 12
LEVELS = 6
SAMPLE = 8192
FREQUENT = 4
MOST_FREQUENT = 1 << 17
BUCKET = 1024
# classes of a block when whole sets are compared
HOOD = 512
FAN = 16
SLICE = 1 << 20

_RNG = np.random.default_rng(90210)
_BYTE = _RNG.integers(0, 1 << 64, 256, np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_FACTORS = _RNG.integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word with A-Z in lower case, first word of each text and the end)."""
    raw, offsets = text_buffer(texts)
    filled = ~_GAP[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(filled & (edge[:-1] | ~np.concatenate([[False], filled[:-1]])))
    ends = np.flatnonzero(filled & (edge[1:] | ~np.concatenate([filled[1:], [False]]))) + 1
    with np.errstate(over="ignore"):
        powers = np.full(len(raw) + 1, _BASE)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        run = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * powers[:-1], out=run[1:])
        powers[1:] = _INVERSE
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        hashes = _mix((run[ends] - run[starts]) * powers[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than a shingle make one."""
    hashes, cuts = word_hashes(texts)
    with np.errstate(over="ignore"):
        run = max(len(hashes) - words + 1, 0)
        sums = np.zeros(run, np.uint64)
        for k in range(words):
            sums += hashes[k:k + run] * _FACTORS[k]
        sums = _mix(sums + np.uint64(words))
        out = []
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            if b - a >= words:
                out.append(np.unique(sums[a:b - words + 1]))
            elif b > a:
                short = (hashes[a:b] * _FACTORS[:b - a]).sum(dtype=np.uint64)
                out.append(_mix(np.array([short + np.uint64(b - a)])))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def first_shingles(found: np.ndarray, percent: int, frequent: np.ndarray, place: np.ndarray
                   ) -> np.ndarray:
    """As many of a set as every set that overlaps enough must share one of.

    The order: shingles not in ``frequent`` by hash, then those by ``place``.
    """
    size = len(found) - -(-percent * len(found) // 100) + 1
    for look in (min(len(found), 2 * size), len(found)):
        at = np.minimum(np.searchsorted(frequent, found[:look]), max(len(frequent) - 1, 0))
        hot = frequent[at] == found[:look] if len(frequent) else np.zeros(look, bool)
        rare = found[:look][~hot]
        if len(rare) >= size:
            return rare[:size]
    last = found[hot][np.argsort(place[at[hot]], kind="stable")]
    return np.concatenate([rare, last[:size - len(rare)]])


def count_vector(found: np.ndarray) -> np.ndarray:
    """Shingles in each group; 65535 stands for any number above.

    There are GROUPS groups for sets of up to GROUPS * FILL shingles and twice as many for
    each doubling (GROUPS << LEVELS at most), so that the counts of unlike sets differ
    enough at every size. The groups of one level fold into those of the level below.
    """
    level = 0
    while level < LEVELS and len(found) > (GROUPS * FILL) << level:
        level += 1
    groups = GROUPS << level
    counts = np.bincount((found & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return np.minimum(counts, 65535).astype(np.uint16)


class Points:
    """Count vectors of several levels."""

    def __init__(self, column: pa.Array, n: np.ndarray):
        raw = column.to_pylist()
        self.n = n
        self.level = np.array([(len(r) // 2 // GROUPS).bit_length() - 1 for r in raw], np.int64)
        self.place, self.whole = np.zeros(len(raw), np.int64), {}
        for level in np.unique(self.level):
            rows = np.flatnonzero(self.level == level)
            self.place[rows] = np.arange(len(rows))
            whole = np.frombuffer(b"".join(raw[r] for r in rows), np.uint16).reshape(len(rows), -1)
            self.whole[level] = np.where(whole == 65535, 1 << 40, whole.astype(np.int64))

    def at(self, rows: np.ndarray, level: int) -> np.ndarray:
        """Vectors of rows of that level or higher, folded down to it."""
        out = np.zeros((len(rows), GROUPS << level), np.int64)
        for own, whole in self.whole.items():
            here = np.flatnonzero(self.level[rows] == own)
            if own >= level and len(here):
                part = whole[self.place[rows[here]]]
                out[here] = part.reshape(len(here), -1, GROUPS << level).sum(axis=1)
        return out

    def bounded(self, i: np.ndarray, j: np.ndarray, percent: int, cells: int = 1 << 20
                ) -> tuple[np.ndarray, np.ndarray]:
        """Those of the pairs of rows whose bound on the overlap reaches the threshold."""
        low, high = np.minimum(self.n[i], self.n[j]), np.maximum(self.n[i], self.n[j])
        fits = 100 * low >= percent * high
        i, j = i[fits], j[fits]
        level, kept = np.minimum(self.level[i], self.level[j]), np.zeros(len(i), bool)
        for each in np.unique(level):
            here = np.flatnonzero(level == each)
            step = max(1, cells // (GROUPS << each))
            for start in range(0, len(here), step):
                part = here[start:start + step]
                x, y = i[part], j[part]
                most = np.minimum(self.at(x, each), self.at(y, each)).sum(axis=1)
                kept[part] = (100 + percent) * most >= percent * (self.n[x] + self.n[y])
        return i[kept], j[kept]

    def pairs(self, one: np.ndarray, two: np.ndarray, percent: int
              ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows ``one`` x ``two`` within the bound, through a tree over each level."""
        for each in sorted(self.whole):
            a, b = one[self.level[one] == each], two[self.level[two] == each]
            over = two[self.level[two] > each], one[self.level[one] > each]
            for x, y in ((a, b), (a, over[0]), (over[1], b)):
                if len(x) and len(y):
                    left = CountTree(self.at(x, each), self.n[x])
                    right = CountTree(self.at(y, each), self.n[y])
                    for p, q in left.pairs(right, percent):
                        yield x[p], y[q]


def _class_of(found: np.ndarray) -> int | None:
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).view(np.int64)) if len(
        found) else None


def _long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


_POINTS = "doc_id long, n long, class long, keys array<long>, point binary"


def _points(words: int, percent: int, frequent: np.ndarray, place: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_slices(batch, "text", SLICE):
                sets = shingle_sets(part.column("text"), words)
                keys = [_long(first_shingles(s, percent, frequent, place)) if len(s)
                        else np.zeros(0, np.int64) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_class_of(s) for s in sets], pa.int64()),
                     pa.array(keys, pa.list_(pa.int64())),
                     pa.array([count_vector(s).tobytes() for s in sets], pa.binary())],
                    names=["doc_id", "n", "class", "keys", "point"])
    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_slices(batch, "text", SLICE):
                sets = shingle_sets(part.column("text"), words)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([_class_of(s) for s in sets], pa.int64()),
                     pa.array([_packed(s) for s in sets], pa.binary())],
                    names=["doc_id", "class", "shingles"])
    return run


def _packed(found: np.ndarray) -> bytes:
    """The upper 48 bits of every hash, in order: enough to tell the shingles of two documents apart."""
    return (found >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(raw) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def frequent_shingles(docs: DataFrame, words: int, sample: int = SAMPLE
                      ) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, place by rising frequency) of shingles in several sampled documents.

    The sample is the documents with the smallest hashes of their ids, about
    ``sample`` of them; equal sets count once. At most MOST_FREQUENT come back.
    """
    share = min(1.0, sample / max(1, docs.count()))
    level = int(share * (1 << 20))
    chosen = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < level)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_slices(batch, "text", SLICE):
                sets = shingle_sets(part.column("text"), words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_class_of(s) for s in sets], pa.int64()),
                     pa.array([_long(s) for s in sets], pa.list_(pa.int64()))],
                    names=["class", "shingles"])

    found = (chosen.select("text").mapInArrow(explode, "class long, shingles array<long>")
             .dropDuplicates(["class"]).select(F.explode("shingles").alias("shingle"))
             .groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT))
    rows = found.toPandas()
    hashes = rows["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    place = np.empty(len(order), np.int64)
    place[np.argsort(rows["n"].to_numpy(np.int64), kind="stable")] = np.arange(len(order))
    return hashes[order], place[order]


# -- the tree ------------------------------------------------------------------------


class CountTree:
    """R-tree over count vectors: sizes and points packed bottom up, FAN to a node."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        points = points.astype(np.int64)
        self.order = np.lexsort((points[:, 0], sizes)) if len(sizes) else np.zeros(0, np.int64)
        top, low, high = points[self.order], sizes[self.order], sizes[self.order]
        # levels from the points up: (largest coordinates, smallest and largest set size)
        self.levels = [(top, low, high)]
        while len(top) > FAN:
            cuts = np.arange(0, len(top), FAN)
            top = np.maximum.reduceat(top, cuts)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((top, low, high))

    def pairs(self, other: CountTree, percent: int, chunk: int = 1 << 14
              ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (here, in other) of all pairs whose bound reaches the threshold."""
        depth = max(len(self.levels), len(other.levels))
        a, b = np.divmod(np.arange(len(self._level(depth - 1)[1]) * len(
            other._level(depth - 1)[1])), max(1, len(other._level(depth - 1)[1])))
        yield from self._down(other, percent, chunk, depth - 1, a, b)

    def _level(self, k: int):
        return self.levels[min(k, len(self.levels) - 1)]

    def _down(self, other, percent, chunk, k, a, b):
        for start in range(0, len(a), chunk):
            x, y = a[start:start + chunk], b[start:start + chunk]
            top_x, low_x, high_x = (v[x] for v in self._level(k))
            top_y, low_y, high_y = (v[y] for v in other._level(k))
            # sizes too far apart, then the bound on the overlap
            fits = (100 * high_x >= percent * low_y) & (100 * high_y >= percent * low_x)
            x, y = x[fits], y[fits]
            most = np.minimum(top_x[fits], top_y[fits]).sum(axis=1)
            fits = (100 + percent) * most >= percent * (low_x[fits] + low_y[fits])
            x, y = x[fits], y[fits]
            if not len(x):
                continue
            if k == 0:
                yield self.order[x], other.order[y]
                continue
            # a tree with fewer levels stays at its top until the other has come down to it
            x, y = self._children(k, x, y)
            y, x = other._children(k, y, x)
            yield from self._down(other, percent, chunk, k - 1, x, y)

    def _children(self, k: int, nodes: np.ndarray, beside: np.ndarray):
        if k >= len(self.levels):
            return nodes, beside
        size = len(self.levels[k - 1][1])
        first = nodes * FAN
        count = np.minimum(first + FAN, size) - first
        ends = np.cumsum(count)
        within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)
        return np.repeat(first, count) + within, np.repeat(beside, count)


def _pairs_inside(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows within each of some small groups."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for m in np.unique(sizes):
        i, j = np.triu_indices(m, 1)
        first = starts[sizes == m][:, None]
        left.append((first + i).ravel())
        right.append((first + j).ravel())
    return np.concatenate(left), np.concatenate(right)


def _near_points(percent: int):
    """In each bucket: the members with a partner within the bound, a row each.

    Buckets that fit into one node of the tree are compared many at a time.
    """
    def found(rows, starts):
        points = Points(rows.column("point"), rows.column("n").to_numpy())
        left = rows.column("in_left").to_numpy(zero_copy_only=False)
        right = rows.column("in_right").to_numpy(zero_copy_only=False)
        sizes = np.diff(starts)
        small = (sizes <= 2 * FAN) & (left & right)[starts[:-1]]
        yield points.bounded(*_pairs_inside(starts[:-1][small], sizes[small]), percent)
        for begin, size in zip(starts[:-1][~small], sizes[~small]):
            sides = (begin + np.flatnonzero(side[begin:begin + size]) for side in (left, right))
            yield from points.pairs(*sides, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in grouped_chunks(batches, ("key", "left", "right")):
            rep, ones, twos = rows.column("rep").to_numpy(), [], []
            for i, j in found(rows, starts):
                apart = rep[i] != rep[j]
                ones.append(i[apart]), twos.append(j[apart])
            i, j = np.concatenate(ones), np.concatenate(twos)
            root = local_components(len(rep), i, j)
            hit = np.zeros(len(rep), bool)
            hit[i] = hit[j] = True
            if hit.any():
                # a part of a bucket that is connected within the bound is a bucket from here on
                key = rows.column("key").to_numpy().view(np.uint64)
                with np.errstate(over="ignore"):
                    part = _mix(key + rep[root].view(np.uint64) * _BASE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[hit].view(np.int64)), pa.array(rep[hit])], names=["key", "rep"])
    return run


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    x, y = (x, y) if len(x) < len(y) else (y, x)
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def _hood_links(percent: int):
    """In each neighbourhood: links between components, as few as connect what is linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped_batches(batches, ("hood", "left", "right")):
            rep, n = rows.column("rep").to_numpy(), rows.column("n").to_numpy()
            points = Points(rows.column("point"), n)
            sets = [_unpacked(s.as_buffer()) for s in rows.column("shingles")]
            sides = [np.flatnonzero(rows.column(c).to_numpy(zero_copy_only=False))
                     for c in ("in_left", "in_right")]
            _, group = np.unique(rows.column("component").to_numpy(), return_inverse=True)
            links = []
            for i, j in points.pairs(*sides, percent):
                once = (rep[i] < rep[j]) | ~np.isin(i, sides[1]) | ~np.isin(j, sides[0])
                for x, y in zip(i[once].tolist(), j[once].tolist()):
                    # looked up again: a link found here may have joined the two
                    if group[x] != group[y] and (
                            (100 + percent) * _common(sets[x], sets[y]) >= percent * (n[x] + n[y])):
                        group[group == group[y]] = group[x]
                        links.append((rep[x], rep[y]))
            if links:
                a, b = np.array(links).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
    return run


def _within_bound(percent: int):
    """Those of some pairs, with both points, whose bound reaches the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            both = [pa.concat_arrays([batch.column(f"{c}_a"), batch.column(f"{c}_b")])
                    for c in ("point", "n")]
            points = Points(both[0], both[1].to_numpy())
            i, _ = points.bounded(np.arange(size), np.arange(size, 2 * size), percent)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(i)) for c in ("a", "b")], names=["a", "b"])
    return run


def _overlaps(percent: int):
    """Links among pairs of whole sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = np.zeros(batch.num_rows, bool)
            for i, (a, b) in enumerate(zip(batch.column("shingles_a"), batch.column("shingles_b"))):
                x, y = _unpacked(a.as_buffer()), _unpacked(b.as_buffer())
                links[i] = (100 + percent) * _common(x, y) >= percent * (len(x) + len(y))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(links)), batch.column("b").filter(pa.array(links))],
                names=["a", "b"])
    return run


def _distinct_buckets(visits: DataFrame) -> DataFrame:
    """(key, rep) of the buckets that several classes share, one of those with equal members.

    Two documents that share most shingles share most buckets; those with the same
    members (by count and 128 bits of their hashes) show the same pairs.
    """
    shared = visits.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    met = settled(visits.join(shared.select("key"), "key"))
    marks = [F.expr(f"bit_xor(xxhash64(rep, {seed}))").alias(f"mark{seed}") for seed in (1, 2)]
    members = met.groupBy("key").agg(F.count(F.lit(1)).alias("m"), *marks)
    kept = members.groupBy("m", "mark1", "mark2").agg(F.min("key").alias("key")).select("key")
    return met.join(kept, "key")


def _blocks(rows: DataFrame, group: str, size: int) -> DataFrame:
    """Rows of groups of two or more, those with more than ``size`` as block pairs."""
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    return block_pairs(rows.join(sizes, group), [group], "rep", "__n", size)


def _sorted(blocks: DataFrame, group: str) -> DataFrame:
    keys = [group, "left", "right"]
    return blocks.repartition(*keys).sortWithinPartitions(*keys)


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                       sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of (doc_id, text).

    Two documents link when 100 * common >= percent * all of their distinct shingles.
    A null text, or one without words, has no shingles and is its own component; a
    text of fewer words than a shingle has one. Rows that repeat a doc_id are one
    document with several texts. A null doc_id takes no part and has a null
    component. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    named = rows.filter("doc_id is not null")
    frequent, place = frequent_shingles(named, words, sample)
    wide = scratch_path(spark, "points")
    everyone = write_once(rows.mapInArrow(_points(words, percent, frequent, place), _POINTS), wide)
    first = F.min(F.struct("doc_id", "n", "keys", "point")).alias("first")
    classes = settled(everyone.filter("class is not null and doc_id is not null")
                          .groupBy("class").agg(first)
                          .select("class", F.col("first.doc_id").alias("rep"), "first.n",
                                  "first.keys", "first.point"))
    members = settled(everyone.select("doc_id", "n", "class"))
    remove(spark, wide)
    points = classes.select("rep", "n", "point")
    met = settled(_distinct_buckets(classes.select("rep", F.explode("keys").alias("key"))))
    buckets = settled(_sorted(_blocks(settled(met.join(points, "rep")), "key", BUCKET), "key").mapInArrow(
        _near_points(percent), "key long, rep long").distinct())
    # small where few documents have near copies: then no text is shuffled
    needed = settled(buckets.select("rep").distinct().join(classes.select("rep", "class"), "rep")
                     .select(F.col("rep").alias("doc_id"), "class"))
    sets = (named.join(needed.select("doc_id"), "doc_id", "left_semi")
            .mapInArrow(_sets(words), "doc_id long, class long, shingles binary")
            .join(needed, ["doc_id", "class"], "left_semi")
            .select(F.col("doc_id").alias("rep"), "class", "shingles"))
    sets = keep_layout(sets, "rep").dropDuplicates(["rep", "class"]).select("rep", "shingles")

    def with_side(pairs: DataFrame, side: str, table_: DataFrame) -> DataFrame:
        return pairs.join(table_.select(*[F.col(c).alias(side if c == "rep" else f"{c}_{side}")
                                          for c in table_.columns]), side)

    def verified(pairs: DataFrame) -> DataFrame:
        both = with_side(with_side(pairs, "a", sets), "b", sets)
        return settled(both.mapInArrow(_overlaps(percent), "a long, b long"))

    def labelled(found: DataFrame | None) -> DataFrame:
        if found is None:
            return buckets.withColumn("component", F.col("rep"))
        return buckets.join(found.withColumnRenamed("id", "rep"), "rep", "left").withColumn(
            "component", F.coalesce("component", "rep"))

    links, tested, found = None, None, None
    # one pivot for all buckets first, then another in each bucket
    for order in (F.col("rep"), F.xxhash64("rep", "key")):
        placed = labelled(found)
        pivots = placed.groupBy("key").agg(
            F.min(F.struct(order.alias("o"), "rep", "component")).alias("p"))
        pairs = placed.join(pivots, "key").filter("component <> p.component").select(
            F.least("rep", "p.rep").alias("a"), F.greatest("rep", "p.rep").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        near = settled(with_side(with_side(pairs, "a", points), "b", points).mapInArrow(
            _within_bound(percent), "a long, b long"))
        tested = near if tested is None else tested.unionByName(near)
        new = verified(near)
        links = new if links is None else links.unionByName(new)
        found = settled(components(links))
    placed = labelled(found)
    mixed = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    rest = settled(placed.join(mixed.filter("x <> y").select("key"), "key"))
    # classes that share such buckets, directly or through others, are one neighbourhood
    pivots = rest.groupBy("key").agg(F.min("rep").alias("p"))
    hoods = components(rest.join(pivots, "key").select(F.col("rep").alias("a"), F.col("p").alias("b")))
    nodes = (rest.select("rep", "component").distinct()
             .join(hoods.select(F.col("id").alias("rep"), F.col("component").alias("hood")), "rep")
             .join(points, "rep"))
    # the sets come last, to rows that are already counted
    held = _sorted(_blocks(settled(nodes), "hood", HOOD).join(sets, "rep"), "hood")
    links = links.unionByName(settled(held.mapInArrow(_hood_links(percent), "a long, b long")))
    found = components(links).withColumnRenamed("id", "rep")
    labels = classes.select("class", "rep").join(found, "rep", "left").select(
        "class", F.coalesce("component", "rep").alias("component"))
    return members.select("doc_id", F.col("n").alias("n_shingles"), "class").join(
        labels, "class", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``docs`` without near copies: of every component the document with the smallest id.

    Equal rows of a document that stays are folded into one; rows without a doc_id stay.
    """
    found = jaccard_components(docs, words, percent)
    kept = found.filter("component_id = doc_id").select("doc_id").distinct()
    # already dealt out by doc_id, so folding equal rows needs no other shuffle
    known = docs.join(kept, "doc_id", "left_semi").dropDuplicates()
    return known.unionByName(docs.filter("doc_id is null"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))

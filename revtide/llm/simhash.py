"""SimHash near-duplicates by vantage-point trees.

Fingerprints that differ in at most ``RADIUS`` bits are linked. Equal fingerprints are one point. A tree
of vantage points, grown on a bounded sample, cuts the space into shards: at each node the points
within the node's distance go left, the others right. A point has one home shard; if it lies within
``RADIUS`` of a boundary, it also visits the shards on the other side that the triangle inequality
cannot rule out. So every linked pair meets in exactly one shard, where a second tree prunes again and
the remaining distances are computed. A shard reports no pairs but a spanning forest of them, so a
group of near copies costs as many rows as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from revtide.llm.common import narrow_batches, packed, text_batches
from revtide.llm.components import components
from revtide.session import stored

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Distinct fingerprints per shard, and how many of them the tree is grown on.
SHARD_POINTS = 4_096
SAMPLE_PER_SHARD = 64
#: Bounds the broadcast tree and its sample (262,144 points); beyond it shards hold more points.
MAX_SHARDS = 4_096
#: Points below which a shard compares without pruning, and queries per block of comparisons.
LEAF = 256
BLOCK = 4_096


def fingerprint_of(text: str | None) -> int:
    """64 bits as a signed long; 0 for a text without words or a null text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < SHINGLE:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts, ends = (ends - lengths).tolist(), ends[SHINGLE - 1:].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[s:e], SEED) for s, e in zip(starts, ends)]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = bits.sum(axis=0, dtype=np.int64)
    chosen = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(chosen.view("<i8")[0])


@pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint_of(t) for t in texts], dtype="int64")


def fingerprint(text: Column) -> Column:
    """Fingerprint of a text: bits set in more than half the hashes of its word shingles.

    Only A-Z are lower-cased; a text of fewer words than a shingle is one shingle.
    """
    return _fingerprints(text)


def hex_digits(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def distance(points: np.ndarray, vantage: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


class VantageTree:
    """Complete binary tree over the Hamming space; leaves are numbered from left to right."""

    def __init__(self, sample: np.ndarray, shards: int):
        self.depth = max(0, int(shards - 1).bit_length())
        nodes = 2 ** self.depth - 1
        self.vantage = np.zeros(nodes, np.uint64)
        self.bound = np.full(nodes, 32, np.int16)
        groups = [sample]
        for level in range(self.depth):
            below = []
            for i, group in enumerate(groups):
                node = 2 ** level - 1 + i
                self.vantage[node] = self._spread(group, node)
                away = distance(group, self.vantage[node])
                if len(group):
                    self.bound[node] = self._middle(away)
                left = away <= self.bound[node]
                below += [group[left], group[~left]]
            groups = below

    @staticmethod
    def _middle(away: np.ndarray) -> int:
        """The distance that cuts a group most evenly."""
        order = np.sort(away)
        half = int(order[(len(order) - 1) // 2])
        return min((half - 1, half), key=lambda b: abs(2 * int((away <= b).sum()) - len(away)))

    @staticmethod
    def _spread(group: np.ndarray, node: int) -> np.uint64:
        """Of a few candidates, the vantage point whose distances vary most: fewest points at the boundary."""
        random = np.random.default_rng(node)
        candidates = random.integers(0, 2 ** 64, 4, np.uint64)
        if len(group):
            candidates = np.concatenate([candidates, random.choice(group, 8)])
            few = random.choice(group, min(len(group), 512))
            return candidates[int(np.argmax([distance(few, c).std() for c in candidates]))]
        return candidates[0]

    def shards(self, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of point, shard, whether it visits); each point has one row in which it doesn't.

        A visitor comes from the low side of a boundary to the high side only, so a pair that a boundary
        parts meets once: at the home of its point on the high side.
        """
        index, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        visits = np.zeros(len(points), bool)
        for _ in range(self.depth):
            away, bound = distance(points[index], self.vantage[node]), self.bound[node]
            low = np.where(visits, away - radius <= bound, away <= bound)
            high = np.where(visits, away + radius > bound, away > bound)
            across = ~visits & low & (away + radius > bound)
            index, node, visits = (
                np.concatenate([index[low], index[high], index[across]]),
                np.concatenate([2 * node[low] + 1, 2 * node[high] + 2, 2 * node[across] + 2]),
                np.concatenate([visits[low], visits[high], np.ones(int(across.sum()), bool)]),
            )
        return index, node - (2 ** self.depth - 1), visits


def near(
    queries: np.ndarray, points: np.ndarray, radius: int = RADIUS
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (query index, point index) within the radius; both sides descend a tree of the points."""
    stack = [(np.arange(len(queries)), np.arange(len(points)))]
    while stack:
        q, p = stack.pop()
        if not len(q) or not len(p):
            continue
        if len(p) > LEAF:
            vantage = points[p[len(p) // 2]]
            away = distance(points[p], vantage)
            bound = VantageTree._middle(away)
            left = away <= bound
            if left.any() and not left.all():
                asked = distance(queries[q], vantage)
                stack.append((q[asked - radius <= bound], p[left]))
                stack.append((q[asked + radius > bound], p[~left]))
                continue
        for i in range(0, len(q), BLOCK):
            for j in range(0, len(p), LEAF):
                some, others = q[i:i + BLOCK], p[j:j + LEAF]
                hit = np.bitwise_count(queries[some, None] ^ points[None, others]) <= radius
                a, b = np.nonzero(hit)
                if len(a):
                    yield some[a], others[b]


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the classes of a and b, in place; a label is the smallest member of its class."""
    while True:
        left, right = labels[a], labels[b]
        apart = left != right
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        left, right = left[apart], right[apart]
        np.minimum.at(labels, np.maximum(left, right), np.minimum(left, right))
        while True:
            upper = labels[labels]
            if (upper == labels).all():
                break
            labels[:] = upper


class _Shard:
    """Links found in one shard: residents arrive first, then visitors in any number of batches."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.points: np.ndarray | None = None

    def ready(self) -> None:
        if self.points is None:
            self.points = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint64)
            self.labels = np.arange(len(self.points))
            for a, b in near(self.points, self.points):
                merge_labels(self.labels, a, b)

    def visit(self, visitors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.ready()
        first = np.full(len(visitors), -1, np.int64)
        for v, p in near(visitors, self.points):
            new = first[v] < 0
            first[v[new]] = p[new]
            merge_labels(self.labels, first[v], p)
        found = first >= 0
        return visitors[found], self.points[first[found]]

    def close(self) -> tuple[np.ndarray, np.ndarray]:
        self.ready()
        linked = self.labels != np.arange(len(self.labels))
        return self.points[linked], self.points[self.labels[linked]]


def _shard_links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of shards that arrive one after the other, residents before visitors."""
    def rows(pair):
        return pd.DataFrame({"a": pair[0].view(np.int64), "b": pair[1].view(np.int64)})

    shard, at = None, None
    for frame in frames:
        number = frame["shard"].to_numpy()
        cuts = np.flatnonzero(np.diff(number)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(number)]):
            if start == end:
                continue
            if number[start] != at:
                if shard is not None:
                    yield rows(shard.close())
                shard, at = _Shard(), number[start]
            points = frame["point"].to_numpy()[start:end].view(np.uint64)
            visits = frame["visits"].to_numpy()[start:end].astype(bool)
            shard.parts.append(points[~visits])
            if visits.any():
                yield rows(shard.visit(points[visits]))
    if shard is not None:
        yield rows(shard.close())


def links(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``point``): a spanning forest of each shard."""
    spark = points.sparkSession
    n = points.count()
    shards = 1
    while shards * SHARD_POINTS < n and shards < MAX_SHARDS:
        shards *= 2
    drawn = []
    if shards > 1:
        share = max(1, n // (shards * SAMPLE_PER_SHARD))
        drawn = points.filter(F.pmod(F.xxhash64("point"), F.lit(share)) == 0).collect()
    tree = VantageTree(np.sort(np.array([r[0] for r in drawn], np.int64)).view(np.uint64), shards)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fingerprints = frame["point"].to_numpy().view(np.uint64)
            index, shard, visits = tree.shards(fingerprints, radius)
            yield pd.DataFrame({
                "shard": shard.astype(np.int32), "visits": visits,
                "point": fingerprints[index].view(np.int64),
            })

    dealt = points.select("point").mapInPandas(deal, "shard int, visits boolean, point long")
    met = dealt.repartition("shard").sortWithinPartitions("shard", "visits")
    with narrow_batches(spark):
        return stored(met.mapInPandas(_shard_links, "a long, b long"), "near")


def classes(prints: DataFrame) -> DataFrame:
    """(point, root) for every distinct ``point`` of a frame; linked points have the same root."""
    points = prints.select("point").distinct()
    roots = components(links(points)).withColumnRenamed("node", "point")
    return points.join(roots, "point", "left").select("point", F.coalesce("root", "point").alias("root"))


def grouped(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, point, component_id) of every row: its fingerprint and the smallest id reachable over links.

    Null texts have fingerprint 0. Null ids count as larger than all others; a component of null ids
    only has a null component_id. Repeated rows are in one component.
    """
    text_batches(df.sparkSession)
    rows = stored(df.select(df[id_column].alias("id"), fingerprint(df[text]).alias("point")), "points")
    least = stored(rows.groupBy("point").agg(F.min("id").alias("least")), "least")
    named = stored(least.join(classes(least), "point"), "named")
    tops = named.groupBy("root").agg(F.min("least").alias("component_id"))
    place = named.join(tops, "root").select("point", "component_id")
    return rows.join(place, "point").select("id", "point", "component_id")


def representatives(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per component, that with the smallest id, with the columns of ``df``.

    Among rows of the same id one text is picked by its hash, and one row among equal ones. Only the ids
    and hashes of rows go through the grouping; a row with its text moves once.
    """
    text_batches(df.sparkSession)
    own = F.xxhash64(df[text])
    rows = stored(
        df.select(df[id_column].alias("id"), own.alias("hash"), fingerprint(df[text]).alias("point")),
        "points",
    )
    order = F.struct(F.col("id").isNull().alias("last"), "id", "hash")
    least = stored(rows.groupBy("point").agg(F.min(order).alias("least")), "least")
    picked = least.join(classes(least), "point").groupBy("root").agg(F.min("least").alias("pick"))
    picked = picked.select("pick.id", "pick.hash")
    same = rows.groupBy("id", "hash").agg(F.count("*").alias("rows"))
    on = lambda a, b: a["id"].eqNullSafe(b["id"]) & (a["hash"] == b["hash"])
    picked = stored(
        picked.join(same, on(picked, same)).select(picked["id"], picked["hash"], "rows"), "picked"
    )
    wide = packed(df, id=df[id_column], hash=own)
    found = wide.join(picked, on(wide, picked)).select("row", wide["id"], wide["hash"], "rows")
    single = found.filter("rows = 1").select("row.*")
    several = found.filter("rows > 1").dropDuplicates(["id", "hash"]).select("row.*")
    return single.unionByName(several)

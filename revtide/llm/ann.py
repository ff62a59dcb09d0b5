"""Nearest neighbours by an adaptive scan over dimensions.

Vectors are dealt to lists by their nearest centroid and kept rotated, in blocks of columns. For each
probed list a query first takes exact distances of the candidates that look nearest after one block; the
worst of its k best is the limit. Then the other blocks are added one by one. After a rotation, the distance
over the first t of D dimensions estimates the whole one, so a candidate whose partial distance, scaled up,
exceeds the limit by more than chance allows is abandoned. Survivors get exact distances. The queries that probe a
list are scanned together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.llm.common import narrow_batches
from revtide.session import stored

#: Rows that the centroids are fitted on, at most (expected value of a hash sample).
SAMPLE = 16_384
MAX_LISTS = 4_096
#: Share of the neighbours in the sample whose lists the probes must reach, and queries that measure it.
REACH = 0.985
TRIALS = 256
BLOCK = 16
#: Standard errors by which a scaled partial distance must exceed the limit to abandon a candidate.
EPSILON = 2.1
#: Vectors and queries per unit of work.
PACK = 2_048
QUERY_PACK = 256
#: Queries whose best a task holds before it hands them on.
QUERIES_PER_TASK = 50_000
#: (query, candidate) pairs that are compared at once.
PAIRS = 65_536
ROUNDS = 8
SEED = 7

PACKED = "list int, ids binary, vectors binary"
FOUND = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Whether a vector has finite components only, and one that is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(dimensions: int) -> np.ndarray:
    """A random rotation, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def fit(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centroids of a sample by Lloyd's rounds; a centroid that loses all its rows moves to a random row."""
    random = np.random.default_rng(SEED)
    centroids = sample[random.permutation(len(sample))[:lists]].copy()
    for _ in range(ROUNDS):
        owner = nearest_lists(sample, centroids, 1)[:, 0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, sample)
        sizes = np.bincount(owner, minlength=len(centroids))
        empty = sizes == 0
        centroids = sums / np.maximum(sizes, 1)[:, None]
        centroids[empty] = sample[random.integers(0, len(sample), int(empty.sum()))]
    return centroids


def nearest_lists(vectors: np.ndarray, centroids: np.ndarray, probes: int) -> np.ndarray:
    """Numbers of the nearest centroids of every vector, nearest first."""
    away = (centroids * centroids).sum(1) - 2 * vectors @ centroids.T
    probes = min(probes, len(centroids))
    if probes == 1:
        return away.argmin(1)[:, None]
    some = np.argpartition(away, probes - 1, axis=1)[:, :probes]
    return np.take_along_axis(some, np.take_along_axis(away, some, 1).argsort(1, kind="stable"), 1)


def probes_for(sample: np.ndarray, centroids: np.ndarray, k: int, reach: float = REACH) -> int:
    """How many lists to probe, measured on the sample.

    For some of its vectors the k nearest others are found by comparing all, and so is the place of their
    lists in the order in which the query would probe them. Data without clusters need many probes,
    clustered data few. In the whole table neighbours are nearer than in a sample of it, so the measure errs
    towards more.
    """
    asked = np.random.default_rng(SEED).permutation(len(sample))[:TRIALS]
    owner = nearest_lists(sample, centroids, 1)[:, 0]
    places = [np.zeros(1, np.int64)]
    for i in asked:
        away = ((sample - sample[i]) ** 2).sum(1)
        away[i] = np.inf
        others = np.argsort(away, kind="stable")[:min(k, len(sample) - 1)]
        order = np.empty(len(centroids), np.int64)
        order[nearest_lists(sample[i:i + 1], centroids, len(centroids))[0]] = np.arange(len(centroids))
        places.append(order[owner[others]])
    return int(np.quantile(np.concatenate(places), reach, method="higher")) + 1


def _packs(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by list as packs of one list each."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    at, rows = None, 0

    def flush():
        ids = np.concatenate([i for i, _ in held])
        vectors = np.concatenate([v for _, v in held])
        for start in range(0, len(ids), size):
            yield at, ids[start:start + size].tobytes(), vectors[start:start + size].tobytes()

    for frame in frames:
        lists = frame["list"].to_numpy()
        cuts = np.flatnonzero(np.diff(lists)) + 1
        out = []
        for start, end in zip([0, *cuts], [*cuts, len(lists)]):
            if start == end:
                continue
            if held and (lists[start] != at or rows >= size):
                out += flush()
                held, rows = [], 0
            at = int(lists[start])
            vectors = np.stack(frame["vector"].to_numpy()[start:end]).astype(np.float64)
            held.append((frame["id"].to_numpy()[start:end].astype(np.int64), vectors))
            rows += end - start
        if out:
            yield pd.DataFrame(out, columns=["list", "ids", "vectors"])
    if held:
        yield pd.DataFrame(list(flush()), columns=["list", "ids", "vectors"])


def scan(
    queries: np.ndarray, turned: np.ndarray, own: np.ndarray, vectors: np.ndarray, blocks: list[np.ndarray], k: int,
    known: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, exact distance) of the candidates that may be among the k nearest of each query.

    ``blocks`` are column blocks of the rotated vectors, ``turned`` the rotated queries, ``own`` marks the
    (query, row) pairs that are no candidates; ``known`` is the distance of the k-th best that each query has from
    other lists. All queries of a pack go through a block together, as pairs that are still alive.
    """
    def exact(q, v):
        away = np.empty(len(q))
        for i in range(0, len(q), PAIRS):
            away[i:i + PAIRS] = np.sqrt(((vectors[v[i:i + PAIRS]] - queries[q[i:i + PAIRS]]) ** 2).sum(1))
        return away

    dimensions, seen, n = queries.shape[1], blocks[0].shape[1], len(vectors)
    if n <= 2 * k:
        q, v = np.nonzero(~own)
        return q, v, exact(q, v)
    asked, held = turned[:, :seen], blocks[0]
    sizes = (asked * asked).sum(1)[:, None] + (held * held).sum(1)
    partial = sizes - 2 * asked @ held.T
    # What the product may lose by cancellation, so that it never abandons a candidate.
    partial -= sizes * 1e-13
    partial[own] = np.inf
    first = np.argpartition(partial, 2 * k - 1, axis=1)[:, :2 * k]
    q, v = np.repeat(np.arange(len(queries)), 2 * k), first.ravel()
    away = np.where(own[q, v], np.inf, exact(q, v))
    limit = np.minimum(known, np.partition(away.reshape(-1, 2 * k), k - 1, axis=1)[:, k - 1])

    def most(seen):
        # A little slack keeps candidates at the limit itself from falling to rounding.
        return (limit * (1 + 1e-9) * (1 + EPSILON / math.sqrt(seen))) ** 2 * seen / dimensions + 1e-18

    tried = np.zeros(partial.shape, bool)
    np.put_along_axis(tried, first, True, 1)
    q2, v2 = np.nonzero((partial <= most(seen)[:, None]) & ~tried & ~own)
    left = partial[q2, v2]
    for block in blocks[1:]:
        width = block.shape[1]
        for i in range(0, len(q2), PAIRS):
            part = slice(i, i + PAIRS)
            left[part] += ((block[v2[part]] - turned[q2[part], seen:seen + width]) ** 2).sum(1)
        seen += width
        bound = most(seen) if seen < dimensions else (limit * (1 + 1e-9)) ** 2 + 1e-18
        alive = left <= bound[q2]
        q2, v2, left = q2[alive], v2[alive], left[alive]
    near = ~own[q, v]
    q, v, away = np.append(q[near], q2), np.append(v[near], v2), np.append(away[near], exact(q2, v2))
    # No candidate beyond the limit can be among the k nearest.
    good = away <= limit[q]
    return q[good], v[good], away[good]


class _Best:
    """The k nearest found so far for each query of a task, bounded in queries."""

    def __init__(self, k: int):
        self.k, self.found = k, {}

    def limit(self, query_id: int) -> float:
        ids, away = self.found.get(query_id, ((), ()))
        return away[-1] if len(ids) == self.k else math.inf

    def add(self, query_id: int, ids: np.ndarray, away: np.ndarray) -> None:
        if query_id in self.found:
            before = self.found[query_id]
            ids, away = np.append(before[0], ids), np.append(before[1], away)
        best = np.lexsort((ids, away))[:self.k]
        self.found[query_id] = ids[best], away[best]

    def rows(self) -> pd.DataFrame:
        found, self.found = self.found, {}
        return pd.DataFrame({
            "query_id": np.repeat(list(found), [len(i) for i, _ in found.values()]),
            "vec_id": np.concatenate([i for i, _ in found.values()]),
            "score": np.concatenate([d for _, d in found.values()]),
        })


def _search(frames: Iterator[pd.DataFrame], dimensions: int, k: int) -> Iterator[pd.DataFrame]:
    """The k nearest in the packs of a task for each query that meets them."""
    turn, best = rotation(dimensions), _Best(k)
    for frame in frames:
        for ids, vectors, query_ids, queries in zip(
            frame["ids"], frame["vectors"], frame["query_ids"], frame["queries"]
        ):
            ids, query_ids = np.frombuffer(ids, np.int64), np.frombuffer(query_ids, np.int64)
            vectors = np.frombuffer(vectors, np.float64).reshape(-1, dimensions)
            queries = np.frombuffer(queries, np.float64).reshape(-1, dimensions)
            turned, asked = vectors @ turn, queries @ turn
            blocks = [np.ascontiguousarray(turned[:, i:i + BLOCK]) for i in range(0, dimensions, BLOCK)]
            step = max(1, PAIRS // max(len(ids), 1))
            for start in range(0, len(query_ids), step):
                names = query_ids[start:start + step]
                known = np.array([best.limit(name) for name in names.tolist()])
                q, v, away = scan(
                    queries[start:start + step], asked[start:start + step], ids == names[:, None], vectors, blocks,
                    k, known,
                )
                order = np.argsort(q, kind="stable")
                q, v, away = q[order], v[order], away[order]
                cuts = np.flatnonzero(np.diff(q)) + 1
                for i, j in zip([0, *cuts], [*cuts, len(q)]):
                    if i < j:
                        best.add(int(names[q[i]]), ids[v[i:j]], away[i:j])
            if len(best.found) > QUERIES_PER_TASK:
                yield best.rows()
    if best.found:
        yield best.rows()


def search(
    df: DataFrame, queries: Column, k: int = 10, id_column: str = "vec_id", vector: str = "embedding",
    probes: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for each row that meets ``queries``.

    Score is the Euclidean distance in double precision; ties go to the smaller id. Rows with a null id,
    and vectors that are null, zero, not finite or of another length than most, take no part. A row is
    no candidate of a query with its id. Rows that repeat an id are candidates each. All vectors are indexed;
    the centroids, at most ``MAX_LISTS``, come from a sample of about ``SAMPLE`` rows. Lists and
    queries travel in packs of bounded size, so a list that holds a third of all rows is many packs. Without
    ``probes`` their number is measured on the sample.
    """
    spark = df.sparkSession
    rows = df.select(
        df[id_column].cast("long").alias("id"), df[vector].cast("array<double>").alias("vector"),
        queries.alias("asks"),
    ).filter(usable(F.col("vector")) & F.col("id").isNotNull())
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimensions, n = lengths
    rows = rows.filter(F.size("vector") == dimensions)
    share = max(1, n // SAMPLE)
    drawn = rows.filter(F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(share)) == 0).select("vector")
    drawn = drawn.unionByName(rows.select("vector").limit(1)).toPandas()["vector"]
    sample = np.stack(drawn.to_numpy()).astype(np.float64)
    centroids = fit(sample, max(1, min(MAX_LISTS, round(math.sqrt(n)), len(sample) // 4 or 1)))
    probes = probes or probes_for(sample, centroids, k)
    shared = spark.sparkContext.broadcast(centroids)

    def assigned(frames, most):
        for frame in frames:
            if not len(frame):
                continue
            vectors = np.stack(frame["vector"].to_numpy()).astype(np.float64)
            lists = nearest_lists(vectors, shared.value, most)
            at = np.repeat(np.arange(len(frame)), lists.shape[1])
            yield pd.DataFrame({
                "list": lists.ravel().astype(np.int32), "id": frame["id"].to_numpy()[at],
                "vector": frame["vector"].to_numpy()[at],
            })

    def packs(source: DataFrame, most: int, size: int, salt: int) -> DataFrame:
        listed = source.select("id", "vector").mapInPandas(
            lambda frames: assigned(frames, most), "list int, id long, vector array<double>"
        )
        dealt = listed.repartition(F.col("list"), F.pmod(F.xxhash64("id"), F.lit(salt)))
        return dealt.sortWithinPartitions("list", "id").mapInPandas(
            lambda frames: _packs(frames, size), PACKED
        )

    with narrow_batches(spark):
        index = stored(packs(rows, 1, PACK, 8), "lists")
        asked = packs(rows.filter("asks").dropDuplicates(["id"]), probes, QUERY_PACK, 1)
        asked = stored(
            asked.select(F.col("list"), F.col("ids").alias("query_ids"), F.col("vectors").alias("queries")),
            "asked",
        )
        # Packs stay where the join has them; adaptive execution splits a list that holds many.
        units = index.join(asked, "list")
        found = stored(
            units.select("ids", "vectors", "query_ids", "queries").mapInPandas(
                lambda frames: _search(frames, dimensions, k), FOUND
            ), "found",
        )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")

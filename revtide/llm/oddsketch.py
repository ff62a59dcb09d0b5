"""MinHash near-dedup by odd sketches.

A document is the set of its distinct word shingles. Of each distinct set, MinHash samples are taken once: bands
of them say which sets meet, and all of them are folded into an odd sketch, a bitmap in which each (sample,
minimum) flips one bit. Samples on which two sets agree cancel in the XOR of their sketches, so its population
count estimates how many differ, most precisely where few do. Sets that meet in a band and whose sketches
differ in no more bits than linked sets can, all but never, are candidates; a bucket reports a spanning forest
of them, not its pairs. What the forests connect is a group, outside which no set has a link. Within groups, full sets decide:
links are verified until all sets of a group are joined or all candidate pairs are refuted.

Buckets and groups of any size are dealt out in chunks, a task for each two of them, so none
must fit into a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import narrow_batches, text_bytes
from revtide.llm.components import components
from revtide.llm.simhash import merge_labels
from revtide.session import stored

SHINGLE = 3
#: Linked are sets with PERCENT * union <= 100 * intersection.
PERCENT = 85
#: Sets at the limit share no band with probability (1 - 0.85 ** ROWS) ** BANDS, below 3 in 10 million.
BANDS, ROWS = 32, 6
SAMPLES = BANDS * ROWS
#: Bits of a sketch, and the standard errors by which linked sets may exceed the expected difference.
BITS = 512
ERRORS = 5.5
#: Sets of a bucket, and sets and shingles of a group, that a task compares with as many others.
BUCKET_CHUNK = 4_096
GROUP_CHUNK = 2_048
SHINGLE_CHUNK = 2_000_000
#: Sets of a bucket up to which all of a batch are compared at once, sketches per block of comparisons, and
#: shingles that are permuted at once.
SMALL = 32
BLOCK = 512
PERMUTED = 128
SEED = 42

_random = np.random.default_rng(SEED)
_MIX = _random.integers(0, 2 ** 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _random.integers(0, 2 ** 64, SAMPLES, np.uint64)
_FACTOR = _random.integers(0, 2 ** 63, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _random.integers(0, 2 ** 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijection of 64 bits that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def difference_limit(percent: int = PERCENT) -> int:
    """Bits in which sketches of linked sets differ at most, up to ``ERRORS`` standard errors.

    d differing samples flip 2 d bits, which leaves BITS (1 - (1 - 2 / BITS) ** 2 d) / 2 odd ones on average.
    """
    share = 1 - percent / 100
    spread = math.sqrt(SAMPLES * share * (1 - share))
    flips = 2 * (SAMPLES * share + ERRORS * spread)
    odd = BITS * (1 - (1 - 2 / BITS) ** flips) / 2
    return min(BITS, math.ceil(odd + ERRORS / 2 * math.sqrt(odd * (1 - odd / BITS) / 2)))


def similarity(bits: int) -> float:
    """Jaccard similarity that a difference of so many bits stands for."""
    if 2 * bits >= BITS:
        return 0.0
    return max(0.0, 1 - math.log(1 - 2 * bits / BITS) / math.log(1 - 2 / BITS) / (2 * SAMPLES))


class Shingler:
    """Sets of shingles as sorted 64-bit hashes; remembers the hashes of words, up to a bound."""

    def __init__(self, remembered: int = 200_000):
        self.remembered = remembered
        self.words: dict[bytes, int] = {}

    def shingles(self, text: str | None) -> np.ndarray:
        """Distinct shingles of a text. Only A-Z are lower-cased; fewer words than a shingle are one."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known, digest = self.words, xxhash.xxh3_64_intdigest
        for word in set(words).difference(known):
            known[word] = digest(word, SEED)
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(known) > self.remembered:
            known.clear()
        n = len(words)
        if n < SHINGLE:
            return mixed((codes * _MIX[:n]).sum(keepdims=True) + np.uint64(n))
        total = codes[:n - SHINGLE + 1] * _MIX[0]
        for i in range(1, SHINGLE):
            total += codes[i:n - SHINGLE + 1 + i] * _MIX[i]
        return np.unique(mixed(total))


def samples(shingles: np.ndarray) -> np.ndarray:
    """MinHash samples of a set that is not empty: of each of ``SAMPLES`` permutations the least place."""
    least = np.full(SAMPLES, 2 ** 64 - 1, np.uint64)
    for at in range(0, len(shingles), PERMUTED):
        some = (shingles[at:at + PERMUTED] ^ _FLIP[:, None]) * _FACTOR[:, None]
        np.minimum(least, some.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A key for each band; equal if all its samples are."""
    keys = (mixed(least).reshape(BANDS, ROWS) * _BAND).sum(axis=1, dtype=np.uint64)
    return mixed(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def odd_sketch(least: np.ndarray) -> bytes:
    """The bitmap in which every (sample, minimum) has flipped the bit it hashes to."""
    places = (mixed(least + _FACTOR) % np.uint64(BITS)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=BITS) & 1 == 1, bitorder="little").tobytes()


PRINTS = "id long, known boolean, digest binary, n long, keys array<long>, sketch binary"


def _prints(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    maker = Shingler()
    for frame in frames:
        rows = []
        for text in frame["text"]:
            own = maker.shingles(text)
            if len(own):
                least = samples(own)
                digest = xxhash.xxh3_128_digest(own.tobytes())
                rows.append((digest, len(own), band_keys(least), odd_sketch(least)))
            else:
                rows.append((None, 0, None, None))
        out = pd.DataFrame(rows, columns=["digest", "n", "keys", "sketch"])
        yield pd.concat([frame[["id", "known"]].reset_index(drop=True), out], axis=1)


def prints(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, digest, n, keys, sketch) of every row; digest, keys and sketch are null for an empty set."""
    # Null ids go beside the ids: a column with nulls would reach pandas as doubles.
    own = df[id_column].cast("long")
    rows = df.select(
        F.coalesce(own, F.lit(0)).alias("id"), own.isNotNull().alias("known"), df[text].alias("text")
    )
    with text_bytes(df.sparkSession):
        found = rows.mapInPandas(_prints, PRINTS)
        return stored(
            found.select(F.when(F.col("known"), F.col("id")).alias("id"), "digest", "n", "keys", "sketch"), "prints"
        )


def _sketches(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u8").reshape(len(column), -1)


def apart(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bits in which each two sketches of two lists differ."""
    bits = np.zeros((len(left), len(right)), np.int16)
    for word in range(left.shape[1]):
        bits += np.bitwise_count(left[:, word, None] ^ right[None, :, word])
    return bits


def forest(sketches: np.ndarray, sides: np.ndarray, limit: int) -> np.ndarray:
    """Labels of a bucket's sketches so that any two within the limit have the same.

    With ``sides`` of both kinds only pairs across count, but for those with the first of a side, which
    stand for all that are near it.
    """
    labels = np.arange(len(sketches))
    near = (apart(sketches[:1], sketches) <= limit)[0]
    labels[near] = 0
    rest = np.flatnonzero(~near)
    for at in range(0, len(rest), BLOCK):
        some = rest[at:at + BLOCK]
        for start in range(0, len(sketches), 4 * BLOCK):
            others = np.arange(start, min(start + 4 * BLOCK, len(sketches)))
            if sides.any() and not sides.all():
                pairs = (sides[some][:, None] != sides[others][None, :]) & (apart(sketches[some], sketches[others]) <= limit)
            else:
                pairs = apart(sketches[some], sketches[others]) <= limit
            a, b = np.nonzero(pairs)
            if len(a):
                merge_labels(labels, some[a], others[b])
    return labels


def _bucket_links(limit: int):
    def links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Forests of buckets that arrive one after the other; the last of a frame waits for the next."""
        held: pd.DataFrame | None = None

        def of(frame: pd.DataFrame) -> pd.DataFrame:
            code = frame.groupby(["key", "low", "high"], sort=False).ngroup().to_numpy()
            points = frame["point"].to_numpy()
            sketches = _sketches(frame["sketch"])
            sizes = np.bincount(code)
            labels = np.arange(len(frame))
            small = sizes[code] <= SMALL
            for step in range(1, min(SMALL, int(sizes.max()))):
                left = np.flatnonzero(small[:-step] & (code[:-step] == code[step:]))
                if not len(left):
                    break
                near = np.bitwise_count(sketches[left] ^ sketches[left + step]).sum(axis=1) <= limit
                merge_labels(labels, left[near], left[near] + step)
            ends = np.cumsum(sizes)
            for group in np.flatnonzero(sizes > SMALL):
                a, b = ends[group] - sizes[group], ends[group]
                labels[a:b] = a + forest(sketches[a:b], frame["side"].to_numpy()[a:b], limit)
            linked = labels != np.arange(len(labels))
            out = pd.DataFrame({"a": points[linked], "b": points[labels[linked]]})
            return out.drop_duplicates()

        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            last = frame.iloc[-1]
            same = (frame["key"] == last["key"]) & (frame["low"] == last["low"]) & (frame["high"] == last["high"])
            whole = frame[~same]
            held = frame[same].reset_index(drop=True)
            if len(whole):
                yield of(whole.reset_index(drop=True))
        if held is not None and len(held):
            yield of(held)

    return links


def _dealt(rows: DataFrame, chunks: str) -> DataFrame:
    """Each row once for every chunk its own one meets: (low, high) names the two, side the row's own."""
    own = F.pmod(F.xxhash64("point"), F.col(chunks))
    rows = rows.withColumn("_own", own).withColumn("_other", F.explode(F.expr(f"sequence(0L, {chunks} - 1)")))
    return rows.select(
        *[c for c in rows.columns if c not in ("_own", "_other", chunks)],
        F.least("_own", "_other").alias("low"), F.greatest("_own", "_other").alias("high"),
        (F.col("_own") > F.col("_other")).alias("side"),
    )


def candidates(points: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b) between points that meet in a band and whose sketches are near: a forest of each bucket."""
    banded = stored(points.select("point", F.explode("keys").alias("key")), "bands")
    sizes = banded.groupBy("key").agg(F.count("*").alias("sets")).filter("sets > 1")
    chunks = F.ceil(F.col("sets") / F.lit(BUCKET_CHUNK)).cast("long")
    sizes = stored(sizes.select("key", chunks.alias("chunks")), "buckets")
    met = banded.join(sizes, "key").join(points.select("point", "sketch"), "point")
    met = _dealt(met, "chunks").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    with narrow_batches(points.sparkSession):
        found = met.mapInPandas(_bucket_links(difference_limit(percent)), "a long, b long")
        return stored(found.distinct(), "candidates")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets are as similar as links ask for."""
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if 100 * small < percent * large:
        return False
    common = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * common >= percent * (len(a) + len(b) - common)


class _Chunk:
    """Sets that a task compares with each other and with others, until all pairs are joined or refuted."""

    def __init__(self, percent: int, limit: int):
        self.percent, self.limit = percent, limit
        self.points: list[int] = []
        self.sets: list[np.ndarray] = []
        self.sketches: list[bytes] = []
        self.sides: list[bool] = []

    def add(self, point: int, shingles: bytes, sketch: bytes, side: bool) -> None:
        self.points.append(point)
        self.sets.append(np.frombuffer(shingles, "<u8"))
        self.sketches.append(sketch)
        self.sides.append(side)

    def links(self) -> list[tuple[int, int]]:
        """A spanning forest of the links, as points."""
        count = len(self.points)
        labels, found = np.arange(count), []
        sizes = np.array([len(s) for s in self.sets], np.int64)
        sketches = np.frombuffer(b"".join(self.sketches), "<u8").reshape(count, -1)
        sides = np.array(self.sides)
        across = sides.any() and not sides.all()
        for i in range(count):
            open_pairs = np.arange(i + 1, count)
            if across:
                open_pairs = open_pairs[sides[open_pairs] != sides[i]]
            alike = 100 * np.minimum(sizes[open_pairs], sizes[i]) >= self.percent * np.maximum(sizes[open_pairs], sizes[i])
            open_pairs = open_pairs[alike & (labels[open_pairs] != labels[i])]
            if not len(open_pairs):
                continue
            near = open_pairs[apart(sketches[i:i + 1], sketches[open_pairs])[0] <= self.limit]
            for j in near.tolist():
                if labels[i] != labels[j] and linked(self.sets[i], self.sets[j], self.percent):
                    low, high = sorted((labels[i], labels[j]))
                    labels[labels == high] = low
                    found.append((self.points[i], self.points[j]))
        return found


def _group_links(percent: int, limit: int):
    def links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk, at = None, None
        for frame in frames:
            out: list[tuple[int, int]] = []
            for row in frame.itertuples(index=False):
                place = (row.root, row.low, row.high)
                if place != at:
                    if chunk is not None:
                        out += chunk.links()
                    chunk, at = _Chunk(percent, limit), place
                chunk.add(row.point, row.shingles, row.sketch, row.side)
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        if chunk is not None:
            yield pd.DataFrame(chunk.links(), columns=["a", "b"], dtype="int64")

    return links


def _with_sets(df: DataFrame, wanted: DataFrame, text: str, id_column: str) -> DataFrame:
    """The wanted points (least id, digest, ...) with their sets, made again from the texts of their rows."""

    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maker = Shingler()
        for frame in frames:
            sets = [maker.shingles(t).tobytes() for t in frame["text"]]
            own = [xxhash.xxh3_128_digest(s) == d for s, d in zip(sets, frame["digest"])]
            yield frame.drop(columns=["text", "digest"]).assign(shingles=sets)[own]

    texts = df.select(df[id_column].cast("long").alias("_id"), df[text].alias("text"))
    rows = wanted.join(texts, wanted["least"].eqNullSafe(texts["_id"]))
    rows = rows.select("point", "root", "n", "sketch", "digest", "text")
    with text_bytes(df.sparkSession):
        made = rows.mapInPandas(make, "point long, root long, n long, sketch binary, shingles binary")
        made = stored(made, "sets")
    # Rows that repeat an id and its text have made their set as often.
    several = stored(made.groupBy("point").count().filter("count > 1").select("point"), "several")
    if several.isEmpty():
        return made
    once = made.join(several, "point", "left_semi").dropDuplicates(["point"])
    return stored(made.join(several, "point", "left_anti").unionByName(once), "sets")


def verified(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) within groups (column ``root``) of sets, enough to join what all links join.

    A large group is first compared with its least point. What that joins needs no comparison with each
    other; the rest meets all, chunk by chunk.
    """
    limit = difference_limit(percent)
    spark = sets.sparkSession
    chunks = F.ceil(F.greatest(F.count("*") / F.lit(GROUP_CHUNK), F.sum("n") / F.lit(SHINGLE_CHUNK)))
    sizes = stored(
        sets.groupBy("root").agg(chunks.cast("long").alias("chunks"), F.min("point").alias("first")), "groups"
    )
    columns = ["root", "point", "sketch", "shingles", "low", "high", "side"]

    def met(rows: DataFrame) -> DataFrame:
        rows = rows.select(*columns).repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
        return rows.mapInPandas(_group_links(percent, limit), "a long, b long")

    with text_bytes(spark):
        alone = sets.join(sizes.filter("chunks = 1"), "root")
        found = met(alone.withColumns({"low": F.lit(0), "high": F.lit(0), "side": F.lit(False)}))
        found = stored(found, "links")
        large = sizes.filter("chunks > 1")
        if large.isEmpty():
            return found
        first = sets.join(large, [sets["point"] == large["first"]], "left_semi")
        first = stored(first.select("root", F.col("point").alias("first"), F.col("shingles").alias("base")), "first")

        def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                near = [
                    linked(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), percent)
                    for a, b in zip(frame["base"], frame["shingles"])
                ]
                yield frame[["root", "first", "point"]].assign(near=near)

        tried = sets.select("root", "point", "shingles").join(first, "root")
        tried = stored(tried.mapInPandas(compare, "root long, first long, point long, near boolean"), "tried")
        joined = tried.filter("near AND point <> first").select(F.col("first").alias("a"), F.col("point").alias("b"))
        rest = tried.filter("NOT near")
        weight = rest.join(sets.select("point", "n"), "point").groupBy("root").agg(
            chunks.cast("long").alias("rests")
        )
        sizes = stored(large.join(weight, "root").select("root", "chunks", "rests"), "rests")
        members = sets.join(sizes, "root").join(rest.select("point", F.lit(True).alias("open")), "point", "left")
        own = F.pmod(F.xxhash64("point"), F.col("chunks"))
        other = F.pmod(F.xxhash64("point", F.lit(1)), F.col("rests"))
        residents = members.filter("open").withColumn("low", other)
        residents = residents.withColumn("high", F.explode(F.expr("sequence(0L, chunks - 1)")))
        # Visitors are all sets of the group, so a chunk of the rest meets every set, its own ones too.
        visitors = members.withColumn("high", own).withColumn("low", F.explode(F.expr("sequence(0L, rests - 1)")))
        pairs = residents.withColumn("side", F.lit(False)).select(*columns).unionByName(
            visitors.withColumn("side", F.lit(True)).select(*columns)
        )
        return stored(found.unionByName(joined).unionByName(met(pairs)), "links")


def grouped(
    df: DataFrame, text: str = "text", id_column: str = "doc_id", percent: int = PERCENT
) -> DataFrame:
    """(id, n_shingles, component_id) of every row: size of its set, smallest id reachable over links.

    Null texts and texts without words have empty sets, which are linked with nothing; their component
    is their own id. Rows with equal sets are linked, so repeated rows are one component. Null ids count as larger
    than all others; a component of null ids only has a null component_id.
    """
    rows = prints(df, text, id_column)
    points = rows.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("least"), F.first("n").alias("n"), F.first("keys").alias("keys"),
        F.first("sketch").alias("sketch"),
    )
    points = stored(points.withColumn("point", F.monotonically_increasing_id()), "points")
    groups = components(candidates(points, percent))
    wanted = stored(
        points.join(groups, points["point"] == groups["node"]).select(
            "least", "digest", "point", "root", "n", "sketch"
        ),
        "wanted",
    )
    links = verified(_with_sets(df, wanted, text, id_column), percent)
    roots = components(links).withColumnRenamed("node", "point")
    named = points.select("digest", "point", "least").join(roots, "point", "left")
    named = stored(named.select("digest", "least", F.coalesce("root", "point").alias("root")), "named")
    tops = named.groupBy("root").agg(F.min("least").alias("component_id"))
    place = named.join(tops, "root").select("digest", "component_id")
    own = rows.select("id", "digest", F.col("n").alias("n_shingles"))
    found = own.join(place, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select("id", "n_shingles", component.alias("component_id"))

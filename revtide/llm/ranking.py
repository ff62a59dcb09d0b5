"""Ranked lexical search over deduplicated bags.

Whatever a document says outside the words of the items cannot change its scores, so a document is
restricted to the items' vocabulary: a bag of (term, tf) pairs and m, which holds its length. Documents with the
same bag and m form a class. They are grouped by a hash with bag and m beside it, so equal hashes of unlike
bags stay apart. Classes, not documents, are scored; a task keeps the best classes of each item. The
members of the best classes are then read in ascending order of id, as many as a ranking can take.

Items go through in blocks of bounded size. What a block's vocabulary and postings take is therefore bounded
and is sent to every task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.llm.common import text_bytes
from revtide.session import stored

TOP = 50
#: Items of a block, and characters of their texts (expected values of a hash split): bounds what is broadcast.
BLOCK_ITEMS = 8_192
BLOCK_CHARS = 8_000_000
#: Cells of a block of scores in a task, and single contributions added up at once.
CELLS = 2_000_000
STEPS = 2_000_000
#: Classes per item that a task holds before it goes back to the best.
HELD = 200_000
LAST = 2 ** 63 - 1

_LOWER = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
BAG = "doc_id long, known boolean, n long, bag binary, hash long"


def terms(text: str | None) -> list[bytes]:
    """Terms of a text: maximal runs of ASCII letters and digits and of all other characters, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def vocabulary(items: list[tuple[int, str | None]]) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    """Numbered terms of items, and for each term the items (their places) that hold it: starts and postings."""
    numbers: dict[bytes, int] = {}
    held: list[list[int]] = []
    for place, (_, text) in enumerate(items):
        for term in dict.fromkeys(terms(text)):
            number = numbers.setdefault(term, len(numbers))
            if number == len(held):
                held.append([])
            held[number].append(place)
    starts = np.cumsum([0, *map(len, held)]).astype(np.int64)
    postings = np.fromiter((p for h in held for p in h), np.int32, int(starts[-1]))
    return numbers, starts, postings


def bag_of(text: str | None, numbers: dict[bytes, int]) -> tuple[int, bytes]:
    """Number of terms of a text, and (term, tf) pairs by term number of those in a vocabulary."""
    found = terms(text)
    counts = Counter(map(numbers.get, found))
    counts.pop(None, None)
    pairs = np.array(sorted(counts.items()), "<i4").reshape(-1, 2)
    return len(found), pairs.tobytes()


def hash_of(bag: bytes) -> int:
    """64 bits of a bag as a signed long."""
    return int(np.uint64(xxhash.xxh64_intdigest(bag)).view(np.int64))


def bags(docs: DataFrame, shared) -> DataFrame:
    """(doc_id, n, bag, hash) of documents (doc_id, text) with terms, by a broadcast vocabulary."""

    def restrict(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = shared.value["numbers"]
        for frame in frames:
            found = [bag_of(text, numbers) for text in frame["text"]]
            out = frame[["doc_id", "known"]].assign(
                n=[n for n, _ in found], bag=[bag for _, bag in found], hash=[hash_of(bag) for _, bag in found]
            )
            yield out[out["n"] > 0]

    # Null ids go beside the ids: a column with nulls would reach pandas as doubles.
    whole = docs.select(
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("known"), "text"
    )
    found = whole.mapInPandas(restrict, BAG)
    return found.select(F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), "n", "bag", "hash")


def length_part(n_docs: int, n_terms: int) -> Column:
    """m of a document: 50 + (50 n N) div L."""
    parts = f"(CAST(50 AS DECIMAL(2)) * n * CAST({n_docs} AS DECIMAL(16))) DIV {max(n_terms, 1)}"
    return F.expr(f"CAST(50 + ({parts}) AS BIGINT)")


def classes(found: DataFrame) -> DataFrame:
    """One row per distinct bag and m: members, smallest id, and a number, which is fixed once it is stored."""
    equal = found.groupBy("hash", "bag", "m").agg(
        F.count("*").alias("members"), F.min(F.coalesce("doc_id", F.lit(LAST))).alias("least")
    )
    return equal.withColumn("class", F.monotonically_increasing_id())


def _entries(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the class, term number and tf of every entry of the bags of a frame."""
    sizes = frame["bag"].map(len).to_numpy() // 8
    pairs = np.frombuffer(b"".join(frame["bag"]), "<i4").reshape(-1, 2).astype(np.int64)
    return np.repeat(np.arange(len(frame)), sizes), pairs[:, 0], pairs[:, 1]


def document_frequencies(equal: DataFrame, size: int) -> np.ndarray:
    """For each term of the vocabulary the documents that hold it: a class counts with all its members."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, np.int64)
        for frame in frames:
            if len(frame):
                place, term, _ = _entries(frame)
                np.add.at(total, term, frame["members"].to_numpy()[place])
        used = np.flatnonzero(total)
        yield pd.DataFrame({"term": used.astype(np.int32), "docs": total[used]})

    counted = equal.select("bag", "members").mapInPandas(count, "term int, docs long")
    df = np.zeros(size, np.int64)
    for row in counted.groupBy("term").agg(F.sum("docs").alias("docs")).collect():
        df[row["term"]] = row["docs"]
    return df


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class _Best:
    """The ``top`` classes of each item by score, then smallest id, of those a task has scored."""

    def __init__(self, items: int, top: int):
        self.items, self.top = items, top
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0
        self.score = np.zeros(items, np.int64)
        self.least = np.full(items, LAST, np.int64)

    def add(self, scores: np.ndarray, least: np.ndarray, number: np.ndarray) -> None:
        ahead = (scores > self.score) | ((scores == self.score) & (scores > 0) & (least[:, None] < self.least))
        place, item = np.nonzero(ahead)
        self.parts.append((item, scores[place, item], least[place], number[place]))
        self.held += len(item)
        if self.held > HELD + 4 * self.items * self.top:
            self.close()

    def close(self) -> tuple[np.ndarray, ...]:
        columns = [np.concatenate(c) for c in zip(*self.parts)] if self.parts else [np.zeros(0, np.int64)] * 4
        item, score, least, number = columns
        order = np.lexsort((number, least, -score, item))
        item = item[order]
        within = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[within < self.top]
        self.parts = [tuple(c[order] for c in columns)]
        self.held = len(order)
        last = within[within < self.top] == self.top - 1
        item, score, least, _ = self.parts[0]
        self.score[item[last]], self.least[item[last]] = score[last], least[last]
        return self.parts[0]


def scored(equal: DataFrame, shared, weight: np.ndarray, numbers: list[int], top: int) -> DataFrame:
    """(number of the item, class, score, least) of each item's best classes in each task's share of them.

    A document among the best ``top`` belongs to a class among the best ``top`` by score and smallest id, so
    no other class is needed.
    """

    items, names = len(numbers), np.array(numbers, np.int64)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts, postings = shared.value["starts"], shared.value["postings"]
        widths = np.diff(starts)
        best = _Best(items, top)
        rows = max(1, CELLS // max(items, 1))
        for frame in frames:
            for at in range(0, len(frame), rows):
                part = frame.iloc[at:at + rows]
                place, term, tf = _entries(part)
                worth = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * part["m"].to_numpy()[place]))
                cells = np.zeros(len(part) * items, np.int64)
                ends = np.cumsum(widths[term])
                cuts = np.searchsorted(ends, np.arange(STEPS, ends[-1] + STEPS, STEPS)) + 1 if len(ends) else []
                for a, b in zip([0, *cuts], [*cuts, len(term)]):
                    if a >= b:
                        continue
                    wide = widths[term[a:b]]
                    offset = np.arange(int(wide.sum())) - np.repeat(np.cumsum(wide) - wide, wide)
                    item = postings[np.repeat(starts[term[a:b]], wide) + offset]
                    np.add.at(cells, np.repeat(place[a:b] * items, wide) + item, np.repeat(worth[a:b], wide))
                best.add(cells.reshape(-1, items), part["least"].to_numpy(), part["class"].to_numpy())
        item, points, least, number = best.close()
        yield pd.DataFrame({"number": names[item], "class": number, "score": points, "least": least})

    return equal.select("class", "m", "bag", "least").mapInPandas(
        score, "number long, class long, score long, least long"
    )


def _ordered(by: list[str], *order: Column):
    return Window.partitionBy(*by).orderBy(*order)


def _first(df: DataFrame, by: list[str], top: int, *order: Column) -> DataFrame:
    """The first rows of each group; each task drops the others before they are shuffled."""
    return df.withColumn("_place", F.row_number().over(_ordered(by, *order))).filter(F.col("_place") <= top)


def members(found: DataFrame, equal: DataFrame, wanted: DataFrame, top: int) -> DataFrame:
    """(class, doc_id) of the ``top`` members of each wanted class by ascending id.

    Where no other class has a class's hash and m, these name it and bags need not be moved again. Classes
    that share them, by a collision of hashes, are told apart by their bags.
    """
    crowded = equal.groupBy("hash", "m").agg(F.count("*").alias("bags")).filter("bags > 1")
    crowded = stored(crowded.select("hash", "m"), "crowded")
    own = stored(equal.join(wanted, "class", "left_semi").select("class", "hash", "m", "bag"), "wanted")
    alone = own.join(crowded, ["hash", "m"], "left_anti").select("class", "hash", "m")
    by_hash = found.join(alone, ["hash", "m"]).select("class", "doc_id")
    by_bag = found.join(crowded, ["hash", "m"], "left_semi").join(
        own.join(crowded, ["hash", "m"], "left_semi"), ["hash", "m", "bag"]
    )
    both = by_hash.unionByName(by_bag.select("class", "doc_id"))
    return _first(both, ["class"], top, F.asc_nulls_last("doc_id")).select("class", "doc_id")


def _block(docs: DataFrame, items: list[tuple[int, str]], top: int) -> DataFrame:
    """The ranking for one block of items (number, text): number, rank, doc_id and score."""
    spark = docs.sparkSession
    numbers, starts, postings = vocabulary(items)
    shared = spark.sparkContext.broadcast({"numbers": numbers, "starts": starts, "postings": postings})
    found = stored(bags(docs, shared), "bags")
    n_docs, n_terms = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = found.filter(F.length("bag") > 0).withColumn("m", length_part(n_docs, n_terms))
    equal = stored(classes(found), "classes")
    weight = weights(document_frequencies(equal, len(numbers)), n_docs)
    best = stored(scored(equal, shared, weight, [number for number, _ in items], top), "scored")
    best = _first(best, ["number"], top, F.desc("score"), F.asc("least"), F.asc("class"))
    best = stored(best.select("number", "class", "score"), "best")
    ranked = best.join(members(found, equal, best.select("class").distinct(), top), "class")
    ranked = _first(ranked, ["number"], top, F.desc("score"), F.asc_nulls_last("doc_id"))
    return ranked.select("number", F.col("_place").alias("rank"), "doc_id", "score")


def ranking(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    top: int = TOP,
) -> DataFrame:
    """The ``top`` documents of each item: item_id, rank (from 1), doc_id, score.

    Null texts have no terms. Equal scores rank by ascending id, null ids last; repeated rows are documents
    each. Items without terms, or whose terms no document holds, have no rows; repeated items have theirs
    each, from one ranking of their text. Other columns of both frames play no part. Ids must be longs.
    """
    spark = docs.sparkSession
    asked = items.select(items[item_id].alias("item_id"), items[item_text].alias("text")).filter("text IS NOT NULL")
    texts = stored(asked.select("text").distinct().withColumn("number", F.monotonically_increasing_id()), "texts")
    count, chars = texts.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(math.ceil(count / BLOCK_ITEMS), math.ceil(chars / BLOCK_CHARS))
    narrow = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text].alias("text"))
    found = spark.createDataFrame([], "number long, rank int, doc_id long, score long")
    with text_bytes(spark):
        for block in range(blocks):
            own = texts.filter(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block)
            own = [(r["number"], r["text"]) for r in own.collect()]
            if own:
                found = found.unionByName(stored(_block(narrow, own, top), "ranking"))
    named = asked.join(texts, "text").select("item_id", "number")
    return named.join(found, "number").select("item_id", "rank", "doc_id", "score")

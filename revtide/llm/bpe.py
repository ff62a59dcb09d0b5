"""Byte-level BPE by a segment tree.

The leaves of the tree are the byte positions of a piece; each holds the rank of the pair that starts
there, or none. The root knows the smallest rank, and going down to the left where both sides have it
finds the leftmost. A merge changes the pair at its place and those of its live neighbours, three updates of
logarithmic length, so a piece of n bytes takes n log n steps however long it is. Short pieces, nearly all, are
merged many at a time: their trees are rows of one array, and each step merges once in every row.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from revtide.llm.common import text_batches

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
NONE = 1 << 60
NO_RANK = np.int32(2 ** 31 - 1)
#: Matches of the pattern that a worker remembers before it starts anew, and the longest of them.
REMEMBERED = 250_000
REMEMBERED_CHARS = 48
#: Bytes of the longest piece that is merged together with others, and bytes that are merged at a time.
TOGETHER = 64
ROWS_TOGETHER = 32_768


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece: always the leftmost pair of the smallest rank merges next."""
    n = len(piece)
    size = 1 << max(0, (n - 1).bit_length())
    after, before = list(range(1, n + 2)), list(range(-1, n))
    tree = [NONE] * (2 * size)
    tree[size:size + n - 1] = [ranks.get(piece[i:i + 2], NONE) for i in range(n - 1)]
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left <= right else right

    def update(place: int, rank: int) -> None:
        node = size + place
        tree[node] = rank
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            least = left if left <= right else right
            if tree[node] == least:
                break
            tree[node] = least
            node >>= 1

    while size > 1 and tree[1] != NONE:
        least, node = tree[1], 1
        while node < size:
            node *= 2
            if tree[node] != least:
                node += 1
        place = node - size
        gone = after[place]
        end = after[gone]
        after[place] = end
        if end <= n:
            before[end] = place
        update(gone, NONE)
        update(place, ranks.get(piece[place:after[end]], NONE) if end < n else NONE)
        left = before[place]
        if left >= 0:
            update(left, ranks.get(piece[left:end], NONE))
    ids, place = [], 0
    while place < n:
        ids.append(ranks[piece[place:after[place]]])
        place = after[place]
    return ids


class Pairs:
    """Ranks of pairs of ids, for whole arrays at once."""

    def __init__(self, ranks: dict[bytes, int]):
        found = [
            (ranks[token[:cut]] << 32 | ranks[token[cut:]], rank)
            for token, rank in ranks.items() for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        keys, values = np.array(sorted(found) or [(-1, 0)], np.int64).T
        self.keys, self.values = np.ascontiguousarray(keys), values.astype(np.int32)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        both = self.rank(np.repeat(self.bytes, 256), np.tile(self.bytes, 256))
        self.of_bytes = both.reshape(256, 256)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NO_RANK`` if there is none or one side is missing (negative)."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        good = (self.keys[at] == wanted) & (left >= 0) & (right >= 0)
        return np.where(good, self.values[at], NO_RANK)


def merged_rows(pieces: list[bytes], width: int, pairs: Pairs) -> list[bytes]:
    """``merged`` for many pieces of at most ``width`` bytes (a power of two), as little-endian ints."""
    found: list[bytes] = []
    step = max(64, ROWS_TOGETHER // width)
    for start in range(0, len(pieces), step):
        found += _merged_rows(pieces[start:start + step], width, pairs)
    return found


def _merged_rows(pieces: list[bytes], width: int, pairs: Pairs) -> list[bytes]:
    """The rows of all pieces lie one after the other in flat arrays small enough for a processor's cache."""
    count, lengths = len(pieces), np.fromiter(map(len, pieces), np.int32, len(pieces))
    raw = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8).reshape(count, width)
    places = np.arange(width, dtype=np.int32)
    inside = places < lengths[:, None]
    # One more column takes what neighbours off the ends would write.
    ids = np.full((count, width + 1), -1, np.int32)
    ids[:, :width] = np.where(inside, pairs.bytes[raw], -1)
    after = np.tile(np.minimum(np.arange(1, width + 2, dtype=np.int32), width), (count, 1))
    before = np.tile(np.arange(-1, width, dtype=np.int32), (count, 1))
    tree = np.full((count, 2 * width), NO_RANK, np.int32)
    tree[:, width:2 * width - 1] = np.where(inside[:, 1:], pairs.of_bytes[raw[:, :-1], raw[:, 1:]], NO_RANK)
    level = width // 2
    while level:
        tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
        level //= 2
    ids, after, before, tree = ids.reshape(-1), after.reshape(-1), before.reshape(-1), tree.reshape(-1)
    levels = width.bit_length() - 1
    row = np.flatnonzero(tree[1::2 * width] != NO_RANK)
    while len(row):
        root, line = row * (2 * width), row * (width + 1)
        least, node = tree[root + 1], np.ones(len(row), np.int64)
        for _ in range(levels):
            node *= 2
            node += tree[root + node] != least
        place = node - width
        gone = after[line + place]
        end = after[line + gone]
        left = before[line + place]
        ids[line + place], ids[line + gone] = least, -1
        after[line + place], before[line + end] = end, place
        tree[root + width + gone] = NO_RANK
        tree[root + node] = pairs.rank(least, ids[line + end])
        inner = np.flatnonzero(left >= 0)
        tree[root[inner] + width + left[inner]] = pairs.rank(ids[line[inner] + left[inner]], least[inner])
        paths = [width + gone.astype(np.int64), node, width + np.where(left >= 0, left, place)]
        for _ in range(levels):
            for path in paths:
                path >>= 1
                child = root + 2 * path
                tree[root + path] = np.minimum(tree[child], tree[child + 1])
        row = row[tree[root + 1] != NO_RANK]
    ids = ids.reshape(count, width + 1)[:, :width]
    live = ids >= 0
    ends = (np.cumsum(live.sum(1)) * 4).tolist()
    flat = ids[live].astype("<i4").tobytes()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def ranks_of(vocabulary: bytes) -> dict[bytes, int]:
    """Ranks by token of a vocabulary file: a line is a token in base64 and its rank."""
    lines = (line.split() for line in vocabulary.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


class Decoder:
    """The bytes of every token."""

    def __init__(self, vocabulary: bytes):
        self.tokens = {rank: token for token, rank in ranks_of(vocabulary).items()}

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Encoder:
    """Encodes with a vocabulary; remembers the ids of matches of the pattern, up to a bound."""

    def __init__(self, vocabulary: bytes, pattern: str):
        self.ranks = ranks_of(vocabulary)
        self.pairs = Pairs(self.ranks)
        self.find = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def pieces(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Ids of matches of the pattern, as little-endian ints."""
        found, groups = {}, defaultdict(lambda: ([], []))
        whole = self.ranks.get
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            rank = whole(raw)
            if rank is not None:
                found[piece] = rank.to_bytes(4, "little")
            elif len(raw) > TOGETHER:
                found[piece] = np.array(merged(raw, self.ranks), "<i4").tobytes()
            else:
                names, raws = groups[(len(raw) - 1).bit_length()]
                names.append(piece)
                raws.append(raw)
        for bits, (names, raws) in groups.items():
            found.update(zip(names, merged_rows(raws, 1 << bits, self.pairs)))
        return found

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of whole texts. Matches that are not known are merged together, each once."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        matches = [self.find(text) for text in texts]
        new = set().union(*matches).difference(known)
        known.update(self.pieces(new))
        out = [np.frombuffer(b"".join([known[m] for m in found]), "<i4") for found in matches]
        for piece in [p for p in new if len(p) > REMEMBERED_CHARS]:
            del known[piece]
        return out


def _kept(shared, key, make):
    """What a worker makes of a broadcast vocabulary, kept beside it and so made once."""
    if key not in shared.value:
        shared.value[key] = make(shared.value["vocabulary"])
    return shared.value[key]


def _broadcast(spark: SparkSession, path: str):
    """The vocabulary file, under a megabyte, read where the job starts."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast({"vocabulary": file.read()})


def encode(spark: SparkSession, text: Column, path: str = VOCABULARY, pattern: str = PATTERN) -> Column:
    """Token ids (array of int) of a text; a null text has none."""
    vocabulary = _broadcast(spark, path)

    @pandas_udf("array<int>")
    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = _kept(vocabulary, pattern, lambda v: Encoder(v, pattern))
        for batch in texts:
            yield pd.Series(coder.encode([t or "" for t in batch]), dtype=object)

    return ids(text)


def decode(spark: SparkSession, ids: Column, path: str = VOCABULARY) -> Column:
    """The bytes that token ids stand for; null for null, an error for an unknown id."""
    vocabulary = _broadcast(spark, path)

    @pandas_udf("binary")
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = _kept(vocabulary, "decoder", Decoder)
        for batch in batches:
            yield batch.map(lambda i: None if i is None else coder.decode(i.tolist()))

    return raw(ids)


def encoded(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), **options) -> DataFrame:
    """The columns ``keep`` of a frame and ``ids``, row by row; nothing is shuffled."""
    text_batches(df.sparkSession)
    ids = encode(df.sparkSession, F.coalesce(df[text], F.lit("")), **options)
    return df.select(*[df[c] for c in keep], ids.alias("ids"))


def decoded(coded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """A frame of ``encoded`` with ``raw``, the bytes of its ids."""
    return coded.withColumn("raw", decode(coded.sparkSession, coded["ids"], path))

"""Quality rules by compression bands.

A text that repeats itself compresses too well, one that holds no language too badly. What is
usual depends on the length, so each length has a band of its own. The whole text and every fixed
chunk of it are compressed with zstandard; a text is rejected if its ratio leaves the band of its
length, or if more than a given share of its bytes is in chunks that leave theirs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from revtide.llm.common import packed, text_batches


@dataclass(frozen=True)
class Band:
    """Allowed ratios of raw to compressed bytes for texts shorter than ``below`` bytes."""

    below: float
    low: float
    high: float


# Short texts hardly compress, whatever they say; the frame of the format alone outweighs them.
# Ordinary prose gets from 1.3 at a few hundred bytes to about 3 at a hundred thousand.
BANDS = (
    Band(128, 0.0, 3.0),
    Band(512, 1.1, 3.5),
    Band(1_024, 1.2, 3.8),
    Band(4_096, 1.3, 4.2),
    Band(32_768, 1.35, 4.8),
    Band(float("inf"), 1.4, 6.0),
)
CHUNK_BYTES = 4_096
MAX_BAD_SHARE = 0.3
LEVEL = 3

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\v\f\r"

#: Bytes of text whose words are numbered together.
STEP_BYTES = 1_000_000

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, ratio double, bad_share double, kept boolean"
)


def band_of(size: int, bands: Sequence[Band]) -> Band:
    return next(b for b in bands if size < b.below)


def compression(
    raw: bytes, compressor, bands: Sequence[Band], chunk_bytes: int
) -> tuple[float, float, bool]:
    """Ratio of the whole, share of bytes in chunks outside their band, and whether the whole is inside.

    No bytes: ratio 1, no bad chunk, inside.
    """
    if not raw:
        return 1.0, 0.0, True
    ratio = len(raw) / len(compressor.compress(raw))
    band = band_of(len(raw), bands)
    bad = 0
    for start in range(0, len(raw), chunk_bytes):
        chunk = raw[start:start + chunk_bytes]
        limits = band_of(len(chunk), bands)
        if not limits.low <= len(chunk) / len(compressor.compress(chunk)) <= limits.high:
            bad += len(chunk)
    return ratio, bad / len(raw), band.low <= ratio <= band.high


def repeated_words(texts: Sequence[Sequence[bytes]], window: int = WINDOW) -> np.ndarray:
    """Per text, its words that lie in a window of words found twice or more in that text.

    Words become numbers, and numbers of neighbours become one number again, so that windows compare
    exactly and all texts of the batch go together.
    """
    lengths = np.array([len(words) for words in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    n = len(owner)
    if n < window:
        return np.zeros(len(texts), np.int64)
    flat = np.empty(n, object)
    flat[:] = [word for words in texts for word in words]
    words = pd.factorize(flat)[0].astype(np.int64)
    codes = pd.factorize(words * len(texts) + owner)[0].astype(np.int64)
    one = codes
    for width in range(1, window):
        codes = pd.factorize(codes[:n - width] * n + one[width:])[0].astype(np.int64)
    starts = len(codes)
    inside = owner[:starts] == owner[window - 1:window - 1 + starts]
    twice = pd.Series(codes).duplicated(keep=False).to_numpy() & inside
    covered = np.zeros(n, bool)
    for k in range(window):
        covered[k:k + starts] |= twice
    return np.bincount(owner, weights=covered, minlength=len(texts)).astype(np.int64)


def measures(
    texts: Sequence[str | None], bands: Sequence[Band], chunk_bytes: int, max_bad_share: float
) -> Iterator[pd.DataFrame]:
    """Rows of ``FIELDS`` for a batch, about a megabyte of text at a time."""
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    at = 0
    while at < len(raws):
        end, size = at, 0
        while end < len(raws) and (end == at or size + len(raws[end]) <= STEP_BYTES):
            size += len(raws[end])
            end += 1
        words = [raw.split() for raw in raws[at:end]]
        rows = []
        for text, raw, own, repeated in zip(texts[at:end], raws[at:end], words, repeated_words(words)):
            lines = [line for line in raw.split(b"\n") if line.strip()]
            ratio, bad, inside = compression(raw, compressor, bands, chunk_bytes)
            failed = len(own) < MIN_WORDS or 100 * int(repeated) > MAX_REPEAT_PERCENT * len(own)
            rows.append((
                len(own),
                len(text or "") - (len(raw) - len(raw.translate(None, SPACE))),
                len(raw) - len(raw.translate(None, SYMBOLS)),
                len(lines) - len(set(lines)),
                int(repeated), failed, ratio, bad,
                not failed and inside and bad <= max_bad_share,
            ))
        yield pd.DataFrame(rows, columns=[f.split()[0] for f in FIELDS.split(", ")])
        at = end


def quality(
    text: Column,
    bands: Sequence[Band] = BANDS,
    chunk_bytes: int = CHUNK_BYTES,
    max_bad_share: float = MAX_BAD_SHARE,
) -> Column:
    """Struct of ``FIELDS`` for a text column.

    A null text counts as empty: no words, so the base rules reject it. Lines without a word are not
    counted as repeated. Long texts are read to their end.
    """
    @pandas_udf(FIELDS)
    def judge(texts: pd.Series) -> pd.DataFrame:
        frames = list(measures(texts.tolist(), bands, chunk_bytes, max_bad_share))
        if not frames:
            return pd.DataFrame(columns=[f.split()[0] for f in FIELDS.split(", ")])
        return pd.concat(frames, ignore_index=True)

    return judge(text)


def judged(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """``row`` (all columns of ``df``) and ``quality`` (struct of ``FIELDS``), one per row of ``df``."""
    text_batches(df.sparkSession)
    return packed(df, quality=quality(df[text], **options))


def kept(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows whose text passes, with the columns of ``df``."""
    return judged(df, text, **options).filter(F.col("quality.kept")).select("row.*")

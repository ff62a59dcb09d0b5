"""Base measures against plain definitions; bands on texts of known kind."""

import base64
import os
import re
from collections import Counter

import zstandard
from texts import TEXTS, awkward, empty

from revtide.llm import compression
from revtide.llm.queries import op6_compression_bands

SPACE = r"[^\x20\x09-\x0D]+"


def plain(text):
    text = text or ""
    words = re.findall(SPACE, text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(SPACE, line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed
    )


def verdict(text):
    raw = (text or "").encode()
    ratio = lambda b: len(b) / len(zstandard.ZstdCompressor(level=3).compress(b))
    inside = lambda b: next(x.low <= ratio(b) <= x.high for x in compression.BANDS if len(b) < x.below)
    bad = sum(len(raw[i:i + 4096]) for i in range(0, len(raw), 4096) if not inside(raw[i:i + 4096]))
    return not plain(text)[5] and inside(raw) and bad <= 0.3 * len(raw)


def test_query_equals_plain(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op6_compression_bands(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert got == plain(docs[r["doc_id"]])
        assert r["kept"] == verdict(docs[r["doc_id"]])


def test_awkward_rows(spark):
    rows = awkward(spark)
    found = compression.judged(rows).collect()
    assert len(found) == rows.count()
    for r in found:
        q = r["quality"]
        assert tuple(q)[:6] == plain(r["row"]["text"])
    assert compression.kept(rows).columns == rows.columns
    assert compression.judged(empty(spark)).count() == 0 == compression.kept(empty(spark)).count()


def test_batches_are_cut(monkeypatch):
    monkeypatch.setattr(compression, "STEP_BYTES", 300)
    frames = list(compression.measures(TEXTS, compression.BANDS, 4096, 0.3))
    assert len(frames) > 3
    rows = [tuple(r)[:6] for f in frames for r in f.itertuples(index=False)]
    assert rows == [plain(t) for t in TEXTS]


def test_bands():
    noise = " ".join(base64.b64encode(os.urandom(30)).decode() for _ in range(400))
    mixed = [" ".join(f"w{i * 7919 % 1009}x{i}" for i in range(2000))]
    for text, good in [(noise, False), ("spam " * 4000, False), (mixed[0] + noise * 2, False)]:
        raw = text.encode()
        ratio, bad, inside = compression.compression(raw, zstandard.ZstdCompressor(level=3), compression.BANDS, 4096)
        assert (inside and bad <= 0.3) == good

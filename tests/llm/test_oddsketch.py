"""Near-duplicate sets against all pairs; sketches against the similarities they stand for."""

import random as rnd
import re

import numpy as np
import pytest
from texts import awkward, empty

from revtide.llm import oddsketch
from revtide.llm.queries import op12_odd_sketches


def plain_set(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 3:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i:i + 3]) for i in range(len(words) - 2)}


def plain(rows):
    """Sorted (id, size, smallest id reachable) by comparing all pairs; null ids are larger than others."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    sets = [plain_set(t) for _, t in order]
    root = list(range(len(order)))
    changed = True
    linked = [
        (i, j) for i in range(len(order)) for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    ]
    while changed:
        changed = False
        for i, j in linked:
            low = min(root[i], root[j])
            if root[i] != low or root[j] != low:
                root[i] = root[j] = low
                changed = True
    return sorted(((order[i][0], len(sets[i]), order[root[i]][0]) for i in range(len(order))), key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.select("id", "n_shingles", "component_id").collect()), key=str)


def test_query_equals_plain(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = op12_odd_sketches(spark, sf_dir)
    assert got(found.withColumnRenamed("doc_id", "id")) == plain(docs)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found.collect())


def edited(words, changes, random):
    words = list(words)
    for _ in range(changes):
        words[random.randrange(len(words))] = f"new{random.randrange(10 ** 9)}"
    return words


def families(seed=1, count=5, members=24, length=120):
    """Texts around a few originals, with similarities on both sides of the limit, and chains of edits."""
    random, rows = rnd.Random(seed), []
    for family in range(count):
        base = [f"w{random.randrange(400)}" for _ in range(length)]
        for k in range(members):
            rows.append(edited(base, k % 6, random))
        for _ in range(8):
            base = edited(base, 2, random)
            rows.append(base)
    return [(1000 + i, " ".join(w)) for i, w in enumerate(rows)]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(6)


@pytest.mark.parametrize("chunks", ["whole", "chunked", "tiny"])
def test_families(spark, monkeypatch, chunks):
    if chunks != "whole":
        monkeypatch.setattr(oddsketch, "BUCKET_CHUNK", 6 if chunks == "chunked" else 2)
        monkeypatch.setattr(oddsketch, "GROUP_CHUNK", 10 if chunks == "chunked" else 3)
        monkeypatch.setattr(oddsketch, "SMALL", 4)
        monkeypatch.setattr(oddsketch, "BLOCK", 5)
    rows = families() + [(5, None), (6, "alone in the world of words")]
    assert got(oddsketch.grouped(docs_of(spark, rows))) == plain(rows)


def test_awkward_rows(spark):
    rows = awkward(spark)
    docs = [(r["doc_id"], r["text"]) for r in rows.collect()]
    found, wanted = got(oddsketch.grouped(rows)), plain(docs)
    assert [r[:2] for r in found] == [r[:2] for r in wanted]
    assert set(found) == set(wanted)
    assert oddsketch.grouped(empty(spark)).count() == 0


def test_ids_that_share_texts(spark):
    base = [(None, "a b c d e"), (None, "a b c d e"), (7, "A b c d E"), (7, "other text of one id"), (7, "a b c d e")]
    rows = base + [(9, "other text of one id")] * 3 + [(2 ** 62 + 1, "x y"), (2 ** 62, "X Y")]
    found = got(oddsketch.grouped(docs_of(spark, rows)))
    assert found.count((9, 3, 7)) == 3 and found.count((7, 3, 7)) == 3 and found.count((None, 3, 7)) == 2
    assert (2 ** 62 + 1, 1, 2 ** 62) in found


def test_hash_sets_are_the_sets():
    maker = oddsketch.Shingler(remembered=3)
    for text in ["", None, "one", "One two", "a b c", "A B c a b C a", "naïve Ärger ok ok ok", "x " * 50]:
        assert len(maker.shingles(text)) == len(plain_set(text))
    assert maker.shingles("one two").tolist() != maker.shingles("two one").tolist()


def pair(similarity, size, random):
    common = round(size * 2 * similarity / (1 + similarity))
    values = random.integers(0, 2 ** 64, 2 * size - common, np.uint64)
    return np.unique(values[:size]), np.unique(np.concatenate([values[:common], values[size:]]))


def test_sketches_of_linked_sets_pass():
    random = np.random.default_rng(3)
    limit = oddsketch.difference_limit()
    bands, bits = [], []
    for _ in range(400):
        a, b = (oddsketch.samples(s) for s in pair(0.85, 200, random))
        bands.append((oddsketch.band_keys(a) == oddsketch.band_keys(b)).sum())
        x, y = (np.frombuffer(oddsketch.odd_sketch(s), np.uint8) for s in (a, b))
        bits.append(int(np.bitwise_count(x ^ y).sum()))
    assert min(bands) > 0 and max(bits) < limit
    estimates = [oddsketch.similarity(b) for b in bits]
    assert abs(np.mean(estimates) - 0.85) < 0.01 and np.std(estimates) < 0.05
    far = [oddsketch.odd_sketch(oddsketch.samples(s)) for s in pair(0.4, 200, random)]
    assert np.bitwise_count(np.frombuffer(far[0], np.uint8) ^ np.frombuffer(far[1], np.uint8)).sum() > limit


@pytest.mark.parametrize("percent", [60, 85, 100])
def test_linked(percent):
    random = np.random.default_rng(4)
    for _ in range(200):
        a, b = (random.choice(40, random.integers(1, 40), replace=False).astype(np.uint64) for _ in "ab")
        want = 100 * len(set(a) & set(b)) >= percent * len(set(a) | set(b))
        assert oddsketch.linked(np.sort(a), np.sort(b), percent) == want


def test_very_long_text():
    text = " ".join(f"word{i % 70_000}" for i in range(2_000_000))
    own = oddsketch.Shingler().shingles(text)
    assert len(own) == 70_000 and len(oddsketch.odd_sketch(oddsketch.samples(own))) == oddsketch.BITS // 8

"""Ranked search against the plain definition, document by document."""

import math
import re

import numpy as np
import pytest
from texts import awkward, empty

from revtide.llm import ranking
from revtide.llm.queries import op11_bag_ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, top=50):
    """Sorted (item_id, rank, doc_id, score)."""
    found = [(i, plain_terms(t)) for i, t in docs]
    found = [(i, t) for i, t in found if t]
    n_docs, n_terms = len(found), sum(len(t) for _, t in found)
    df = {}
    for _, t in found:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    rows = []
    for item, text in items:
        scores = []
        for i, t in found:
            m, score = 50 + 50 * len(t) * n_docs // n_terms, 0
            for term in set(plain_terms(text)):
                if tf := t.count(term):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += w * (1_000_000_000 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        rows += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top])]
    return sorted(rows, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_query_equals_plain(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert got(op11_bag_ranking(spark, sf_dir)) == plain(docs, items)


ITEMS = [
    (1, "The committee, the PRICE of bread"), (2, "na 漢字 emoji"), (2, "lunch"), (3, None), (4, ""), (5, "unheard-of zebras"),
    (6, "line line LINE again"), (None, "lunch"), (7, "i'll x9 3 4567 apples " + "w " * 20_000), (8, "one"), (8, "one"),
]
ITEM_SCHEMA = "item_id long, text string, doc_id string, n int, hash string, number string"


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "d", 1, "h", "n") for i, t in rows], ITEM_SCHEMA)


@pytest.mark.parametrize("case", ["whole", "blocks", "few", "collisions", "short steps"])
def test_awkward_rows(spark, monkeypatch, case):
    top = 50
    if case == "blocks":
        monkeypatch.setattr(ranking, "BLOCK_ITEMS", 2)
    if case == "few":
        top = 2
    if case == "collisions":
        monkeypatch.setattr(ranking, "hash_of", lambda bag: 7)
    if case == "short steps":
        monkeypatch.setattr(ranking, "CELLS", 3)
        monkeypatch.setattr(ranking, "STEPS", 2)
        monkeypatch.setattr(ranking, "HELD", -10_000)
    rows = awkward(spark)
    docs = [(r["doc_id"], r["text"]) for r in rows.collect()]
    assert got(ranking.ranking(rows, items_of(spark, ITEMS), top=top)) == plain(docs, ITEMS, top)


def test_empty_tables(spark):
    assert got(ranking.ranking(empty(spark), items_of(spark, ITEMS))) == []
    assert got(ranking.ranking(awkward(spark), items_of(spark, []))) == []
    assert got(ranking.ranking(awkward(spark), items_of(spark, [(1, None)]))) == []


def test_a_large_class_expands_by_ascending_id(spark):
    rows = [(2 ** 60 + i * 7 % 301, "alpha beta gamma") for i in range(301)] + [(5, "alpha"), (6, "delta epsilon")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = [(1, "beta"), (2, "alpha"), (3, "epsilon")]
    assert got(ranking.ranking(docs, items_of(spark, items), top=20)) == plain(rows, items, 20)


def test_best_keeps_ties_by_least_id():
    random = np.random.default_rng(2)
    scores, least = random.integers(0, 4, (400, 3)), random.permutation(400)
    best = ranking._Best(3, 5)
    for at in range(0, 400, 37):
        best.add(scores[at:at + 37], least[at:at + 37], np.arange(at, min(at + 37, 400)))
        if at % 2:
            best.close()
    found = sorted(zip(*map(list, best.close())))
    wanted = sorted(
        (k, s, o, c) for k in range(3) for s, o, c in
        [(scores[c, k], least[c], c) for c in sorted(range(400), key=lambda c: (-scores[c, k], least[c]))[:5]]
    )
    assert found == wanted


def test_very_long_text():
    numbers, _, _ = ranking.vocabulary([(0, "aa bb")])
    n, bag = ranking.bag_of("aa bb cc " * 700_000, numbers)
    assert n == 2_100_000 and np.frombuffer(bag, "<i4").tolist() == [0, 700_000, 1, 700_000]

"""Fingerprints and components against plain definitions, tree searches against all pairs."""

import re

import numpy as np
import pytest
import xxhash
from texts import awkward, empty

from revtide.llm import simhash
from revtide.llm.components import components
from revtide.llm.queries import op5_vantage_simhash


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    runs = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """{id: smallest id reachable} by comparing all pairs."""
    ids, root = sorted(prints), {}
    for i in ids:
        root[i] = i
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (prints[a] ^ prints[b]).bit_count() <= 3 and root[b] > root[a]:
                    root[b], changed = root[a], True
    return root


def test_query_equals_plain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs}
    roots = plain_components(prints)
    found = op5_vantage_simhash(spark, sf_dir).collect()
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in found} == {
        (i, f"{prints[i]:016x}", roots[i]) for i in prints
    }
    assert len(found) == len(docs)


def clustered(n, seed=3):
    random = np.random.default_rng(seed)
    base = random.integers(0, 2 ** 64, n, np.uint64)
    flips = np.uint64(1) << random.integers(0, 64, (n, 2), np.uint64)
    return np.unique(np.concatenate([base, base[: n // 2] ^ flips[: n // 2, 0], base ^ flips[:, 0] ^ flips[:, 1]]))


def pairs(points):
    a, b = np.nonzero(np.triu(np.bitwise_count(points[:, None] ^ points[None]) <= 3, 1))
    return set(zip(points[a].tolist(), points[b].tolist()))


@pytest.mark.parametrize("shards", [1, 2, 8, 32])
def test_every_pair_meets_once(shards):
    points = clustered(400)
    tree = simhash.VantageTree(points[::3], shards)
    index, shard, visits = tree.shards(points, 3)
    assert np.bincount(index[~visits]).tolist() == [1] * len(points)
    met = []
    for s in range(shards):
        home, guests = points[index[(shard == s) & ~visits]], points[index[(shard == s) & visits]]
        met += [frozenset(x) for x in pairs(home)]
        a, b = np.nonzero(np.bitwise_count(guests[:, None] ^ home[None]) <= 3)
        met += [frozenset(x) for x in zip(guests[a].tolist(), home[b].tolist())]
    assert len(met) == len(set(met))
    assert set(met) == {frozenset(x) for x in pairs(points)}


def test_search_in_a_shard_equals_all_pairs(monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 16)
    points, queries = clustered(300), clustered(300)[::2]
    found = {(queries[q], points[p]) for a, b in simhash.near(queries, points) for q, p in zip(a, b)}
    a, b = np.nonzero(np.bitwise_count(queries[:, None] ^ points[None]) <= 3)
    assert found == set(zip(queries[a], points[b]))


def test_links_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_POINTS", 100)
    points = clustered(600)
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "point long")
    found = {r["point"]: r["root"] for r in simhash.classes(frame).collect()}
    prints = dict(enumerate(points.tolist()))
    plain = plain_components(prints)
    mine = [found[int(p)] for p in points.view(np.int64)]
    for i in prints:
        assert (mine[i] == mine[plain[i]])
    assert len(set(mine)) == len(set(plain.values()))


def test_components_of_chain_star_and_ring(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1300)]
    ring = [(i, 500 + (i + 1 - 500) % 40) for i in range(500, 540)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + star + ring + [(1, 1)], "a long, b long")).collect()}
    assert {found[i] for i in range(100, 161)} == {100}
    assert {found[i] for i in range(1000, 1300)} == {7} and found[7] == 7
    assert {found[i] for i in range(500, 540)} == {500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows(spark):
    rows = awkward(spark)
    found = {(r["id"], r["point"]): r["component_id"] for r in simhash.grouped(rows).collect()}
    by_id = {i: c for (i, _), c in found.items() if i is not None}
    assert by_id[5] == by_id[6] == 5 and by_id[0] == by_id[1] == by_id[2] == 0
    assert all(c is not None for c in found.values())
    kept = simhash.representatives(rows).collect()
    assert sum(r["doc_id"] == 5 for r in kept) == 1 and not any(r["doc_id"] == 6 for r in kept)
    assert kept[0].asDict().keys() == set(rows.columns)
    assert len(kept) == len(set(found.values()))
    assert simhash.grouped(empty(spark)).count() == 0
    assert simhash.representatives(empty(spark)).count() == 0


def test_component_of_null_ids(spark):
    rows = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e")], "doc_id long, text string")
    assert [r["component_id"] for r in simhash.grouped(rows).collect()] == [None, None]
    assert simhash.representatives(rows).count() == 1

"""Neighbours against comparing all; recall, ties, and vectors that take no part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revtide.llm import ann
from revtide.llm.queries import op1_adaptive_ann


def exact(rows, query, k=10):
    away = sorted((float(np.sqrt(((v - rows[query]) ** 2).sum())), i) for i, v in rows.items() if i != query)
    return [(i, d) for d, i in away[:k]]


def test_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in table}
    found = {}
    for r in op1_adaptive_ann(spark, "/root/testdata/sf0.1").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {i for i in rows if i % 100 == 0}
    hits = 0
    for query, own in found.items():
        own.sort()
        assert [r for r, *_ in own] == list(range(1, 11))
        assert all(s == pytest.approx(np.sqrt(((rows[i] - rows[query]) ** 2).sum()), abs=1e-12) for _, i, s in own)
        hits += len({i for _, i, _ in own} & {i for i, _ in exact(rows, query)})
    assert hits / (10 * len(found)) >= 0.9


def test_ties_and_unusable_vectors(spark):
    rows = [(i, [1.0, float(i % 3)]) for i in range(9)] + [
        (100, None), (101, [0.0, 0.0]), (102, [float("nan"), 1.0]), (103, [1.0, None]), (None, [1.0, 0.0]), (104, [1.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.search(frame, F.col("vec_id") == 0, k=4).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(3, 0.0), (6, 0.0), (1, 1.0), (4, 1.0)]
    assert ann.search(frame.filter("vec_id > 99"), F.lit(True)).count() == 0
    assert ann.search(frame.limit(0), F.lit(True)).count() == 0
    assert ann.search(frame.filter("vec_id = 1"), F.lit(True)).count() == 0

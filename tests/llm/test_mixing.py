"""The mix against SQL; targets, copies and awkward rows."""

import pytest
from compare import difference
from pyspark.sql import functions as F
from texts import awkward, empty

from revtide.llm import mixing
from revtide.llm.common import ranked, word_count


def test_query_equals_sql(spark, con, sf_dir, monkeypatch):
    monkeypatch.setattr("compare.BANNED", [])
    assert difference(spark, con, "op10_systematic_mix", sf_dir) is None


def plain_targets(sizes):
    """Targets by handing the excess on until none is above its end."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(sizes, 0.0), set(sizes)
    while left > 1e-9 and open_:
        level = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            target[s] += weight[s] * level
            if target[s] > 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2 * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 5, None: 40}, {"a": 10}, {"x": 0, "y": 7}, {"b": 1000, "é": 10, "z": 3, "A": 3}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    assert found == pytest.approx(plain_targets(sizes))


def test_taken_words_come_near_the_target(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("source"),
        (F.pmod(F.xxhash64("id"), F.lit(97)) + 1).alias("size"),
    )
    out = mixing.mixed(rows, "source", F.col("size"), [F.col("doc_id")])
    for r in out.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r["taken"] - r["target"]) <= 2 * 97
    assert out.agg(F.max("copies")).first()[0] <= 2
    again = mixing.mixed(rows.repartition(5), "source", F.col("size"), [F.col("doc_id")])
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))


def test_ranks_over_many_partitions(spark):
    rows = spark.range(3000).select((F.col("id") % 2).alias("g"), F.pmod(F.xxhash64("id"), F.lit(500)).alias("v"))
    for within in ([], ["g"]):
        found = ranked(rows, within, [F.col("v")]).collect()
        for g in {tuple(r[c] for c in within) for r in found}:
            own = sorted((r["rank"], r["v"]) for r in found if tuple(r[c] for c in within) == g)
            assert [r for r, _ in own] == list(range(1, len(own) + 1))
            assert [v for _, v in own] == sorted(v for _, v in own)


def test_awkward_rows(spark):
    rows = awkward(spark)
    found = mixing.mixed(rows, "source", word_count(rows["text"]), [rows["doc_id"]]).collect()
    assert len(found) == rows.count()
    assert all(r["size"] == 0 for r in found if not r["row"]["text"])
    taken = mixing.mix(rows, "source", word_count(rows["text"]), [rows["doc_id"]])
    assert taken.columns == rows.columns
    assert taken.count() == sum(r["copies"] for r in found)
    assert mixing.mix(empty(spark), "source", F.lit(1).cast("long"), []).count() == 0


def test_equal_rows_share_their_copies(spark):
    rows = spark.range(40).select(
        F.when(F.col("id") < 30, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("s").alias("source"),
        F.lit(3).cast("long").alias("size"), (F.col("id") % 2).alias("other"),
    ).repartition(4)
    taken = mixing.mix(rows, "source", F.col("size"), [F.col("doc_id")])
    plain = mixing.mixed(rows, "source", F.col("size"), [F.col("doc_id")])
    assert taken.count() == plain.agg(F.sum("copies")).first()[0] == 60
    assert taken.filter("doc_id = 7").count() == plain.filter("row.doc_id = 7").agg(F.sum("copies")).first()[0]

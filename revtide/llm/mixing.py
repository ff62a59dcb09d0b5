"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, the source's target divided by
its size. Documents are laid out in order of size; the running sum of expected copies plus one
random offset per source crosses a whole number now and then, and each crossing emits the document
once. In order of size, neighbours stand for each other, so the words taken differ from the target
by about one large document at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import packed, ranked
from revtide.session import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_COPIES = 2
SEED = "mix-1"


def offset(source: Column, seed: str = SEED) -> Column:
    """Random number in [0, 1) that depends on the seed and the source only."""
    name = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit(":"), source), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MAX_COPIES,
) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources in order of code points, null last, get the weights in turn, and share ``share`` of all sizes.
    A target ends at ``most`` times its source's size. All sources below that end have the same target
    per weight, the level; each round raises it by what the sources above it leave over. Only sums
    leave the cluster. A source without words has target 0.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = ranked(totals, [], [F.col("source").asc_nulls_last()], "place")
    turn = ((F.col("place") - 1) % len(weights)).cast("int")
    weight = F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long")
    sources = stored(order.select("source", "source_size", weight.alias("weight")), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    end = F.lit(most) * F.col("source_size")
    level, before = 0.0, None
    while total and level != before:
        above = F.col("weight") * F.lit(level) > end
        full, free = sources.agg(
            F.sum(F.when(above, F.col("source_size"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        before, level = level, (share * total - most * (full or 0)) / free if free else level
    target = F.least(F.col("weight") * F.lit(level), end.cast("double"))
    return stored(sources.select("source", "source_size", target.alias("target")), "targets")


def mixed(df: DataFrame, source: str, size: Column, ties: list[Column]) -> DataFrame:
    """``row`` (all columns of ``df``), source, size, source_size, target and copies of every document.

    ``ties`` orders documents of one source and size. Rows that agree in all of it are the same for
    the mix; which of them is taken does not matter.
    """
    rows = packed(df, source=df[source], size=size, **{f"_tie{i}": c for i, c in enumerate(ties)})
    targets = source_targets(rows)
    order = ["size", *[f"_tie{i}" for i in range(len(ties))]]
    placed = ranked(rows, ["source"], [F.col(c).asc_nulls_first() for c in order])
    goal = targets.withColumnRenamed("source", "_of")
    joined = placed.join(goal, placed["source"].eqNullSafe(goal["_of"]))
    rate = F.try_divide("target", "source_size")
    start = offset(F.col("source"))
    crossed = F.floor(start + F.col("rank") * rate) - F.floor(start + (F.col("rank") - 1) * rate)
    copies = F.least(F.coalesce(crossed, F.lit(0)), F.lit(MAX_COPIES)).cast("int")
    return joined.select("row", "source", "size", "source_size", "target", copies.alias("copies"))


def mix(df: DataFrame, source: str, size: Column, ties: list[Column]) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``df``.

    Only source, size and ties are ranked. The copies then go back to the rows, which move once and are not
    sorted. Rows that agree in source and ties share their copies, in any order.
    """
    names = [f"_same{i}" for i in range(1 + len(ties))]
    narrow = df.select(df[source].alias("_same0"), size.alias("size"), *[t.alias(n) for t, n in zip(ties, names[1:])])
    narrow = stored(narrow, "sizes")
    drawn = mixed(narrow, "_same0", F.col("size"), [F.col(n) for n in names[1:]])
    taken = drawn.groupBy(*[F.col("row")[n].alias(n) for n in names]).agg(
        F.count("*").alias("rows"), F.sum("copies").alias("copies")
    )
    taken = stored(taken.filter("copies > 0"), "taken")
    wide = packed(df, **{f"_own{i}": c for i, c in enumerate([df[source], *ties])})
    on = [wide[f"_own{i}"].eqNullSafe(taken[n]) for i, n in enumerate(names)]
    found = wide.join(taken.hint("shuffle_hash"), on)
    single = found.filter("rows = 1").select("row", "copies")
    if not taken.filter("rows > 1").isEmpty():
        # Equal rows are numbered and get the whole copies that the steps of their common sum cross.
        several = stored(found.filter("rows > 1").select("row", "rows", "copies", *names), "several")
        several = ranked(several.withColumn("_n", F.monotonically_increasing_id()), names, [F.col("_n")])
        share = F.floor(F.col("rank") * F.col("copies") / F.col("rows")) - F.floor(
            (F.col("rank") - 1) * F.col("copies") / F.col("rows"))
        single = single.unionByName(several.select("row", share.alias("copies")).filter("copies > 0"))
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies").cast("bigint")))
    return single.withColumn("_copy", copy).select("row.*")

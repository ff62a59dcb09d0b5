"""Whitening of embeddings by QR, bidiagonalisation and qd transforms.

Entries become whole numbers, so that equal vectors are equal and sums are exact. Each distinct vector counts
once. Tasks reduce their centred rows block by block to a triangular R by Householder QR; the R of many tasks are
stacked and reduced again, some at a time, until one is left, of the size of the dimension squared however many
rows there are. Its squared singular values over n are the variances, its right singular vectors the
directions (``bidiagonal``). No covariance matrix is formed to get them, which would square the condition.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from revtide.llm.bidiagonal import right_singular
from revtide.llm.common import narrow_batches, packed
from revtide.session import stored

COMPONENTS = 16
STEP, OFFSET = 64, 1_000_000
#: Entries beyond this size have no exact whole number as a double; their rows take no part.
LARGEST = 2.0 ** 46
#: Rows of a block that is reduced at once, and triangles that one task merges.
BLOCK = 2_048
FAN = 32


def longs(vector: Column) -> Column:
    """Entries as whole numbers, floor(64 c) + 1000000."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * STEP) + F.lit(OFFSET).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector has entries, all finite and none too large for an exact whole number."""
    finite = F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(LARGEST))
    )
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


@dataclass
class Model:
    """What a whitening needs: sizes and sums of the fit list, directions (rows) with their variances."""

    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly: in 64 bits where that is sure to suffice, else as Python's whole numbers."""
        largest = max(int(np.abs(x).max(initial=0)), 1)
        if self.n * largest + max(map(abs, self.sums)) < 2 ** 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def deviation(self, centred: np.ndarray) -> list[int]:
        """Sums of squares of ``centred`` rows, exactly."""
        if centred.dtype != object:
            largest = int(np.abs(centred).max(initial=0))
            if largest * largest * max(centred.shape[1], 1) < 2 ** 62:
                return (centred * centred).sum(axis=1).tolist()
            centred = centred.astype(object)
        return (centred * centred).sum(axis=1).tolist()

    def white(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.n) @ self.directions.T / np.sqrt(self.variances)


def _rows(frame: pd.DataFrame) -> np.ndarray:
    return np.stack(frame["x"].to_list()).astype(np.int64, copy=False)


def _totals(fit: DataFrame, dimensions: int) -> tuple[int, list[int]]:
    """Rows of the fit list and exact sums of its dimensions; only those sums leave the cluster."""
    places = fit.select(F.posexplode("x").alias("place", "entry"))
    sums = places.groupBy("place").agg(F.sum(F.col("entry").cast("decimal(20,0)")).alias("total"))
    found = {r["place"]: int(r["total"]) for r in sums.collect()}
    return fit.count(), [found.get(i, 0) for i in range(dimensions)]


def _triangle(blocks: Iterator[np.ndarray], dimensions: int) -> np.ndarray | None:
    """R of the rows of all blocks, stacked: each block is reduced together with the R so far."""
    r = None
    for block in blocks:
        for start in range(0, len(block), BLOCK):
            part = block[start:start + BLOCK]
            r = np.linalg.qr(part if r is None else np.vstack([r, part]), mode="r")
    if r is not None and len(r) < dimensions:
        r = np.vstack([r, np.zeros((dimensions - len(r), dimensions))])
    return r


def _reduced(fit: DataFrame, model: Model) -> np.ndarray:
    """R of all centred rows. Merging takes rounds, each by tasks that hold a few triangles."""
    dimensions = len(model.sums)

    def shape(blocks: Iterator[np.ndarray]) -> Iterator[pd.DataFrame]:
        r = _triangle(blocks, dimensions)
        if r is not None:
            yield pd.DataFrame({"r": [r.tobytes()]})

    def reduce_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from shape(model.centred(_rows(f)).astype(np.float64) / model.n for f in frames if len(f))

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from shape(np.frombuffer(raw).reshape(-1, dimensions) for f in frames for raw in f["r"])

    parts = stored(fit.mapInPandas(reduce_rows, "r binary"), "triangles")
    while (left := parts.count()) > 1:
        parts = stored(parts.repartition(math.ceil(left / FAN)).mapInPandas(merge, "r binary"), "triangles")
    return np.frombuffer(parts.first()["r"]).reshape(dimensions, dimensions)


def _identity_error(fit: DataFrame, model: Model) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, over the fit list."""
    k = len(model.variances)

    def products(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((k, k))
        for frame in frames:
            if len(frame):
                white = model.white(model.centred(_rows(frame)))
                total += white.T @ white
        yield pd.DataFrame({"place": np.arange(k * k), "part": total.ravel()})

    sums = fit.mapInPandas(products, "place int, part double").groupBy("place").agg(F.sum("part").alias("part"))
    covariance = np.zeros(k * k)
    for row in sums.collect():
        covariance[row["place"]] = row["part"] / model.n
    return float(np.abs(covariance.reshape(k, k) - np.eye(k)).max(initial=0))


def prepared(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """(row, x) of the rows that take part: ``row`` holds all columns, ``x`` the entries as whole numbers.

    Vectors that are null, empty or hold null, non-finite or huge entries take no part, nor do those of
    another length than most rows have (of equally frequent lengths the largest counts).
    """
    rows = packed(df.filter(usable(df[vector])), x=longs(df[vector]))
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("length")).first()
    return rows.filter(F.size("x") == (usual["length"] if usual else 0))


def fitted(rows: DataFrame, components: int = COMPONENTS) -> Model:
    """The whitening of rows with a column ``x``, learnt from each distinct ``x`` once.

    Directions without variance are no components, so there may be fewer than asked for, and none where
    all vectors are equal or there is no row.
    """
    with narrow_batches(rows.sparkSession):
        fit = stored(rows.select("x").distinct(), "distinct")
        first = fit.first()
        if first is None:
            return Model(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
        n, sums = _totals(fit, len(first["x"]))
        model = Model(n, sums, np.zeros((0, len(sums))), np.zeros(0), 0.0)
        r = _reduced(fit, model)
        values, model.directions = right_singular(r, components)
        model.variances, model.trace = values / n, float((r * r).sum()) / n
        model.identity_error = _identity_error(fit, model)
    return model


def whitened(rows: DataFrame, model: Model) -> DataFrame:
    """``row``, component (from 1), n, deviation, whitened, explained and identity_error.

    ``rows`` are ``prepared``; each gives one row for every component. ``deviation`` is a decimal: n x - S
    squared and summed outgrows a long where n does. Repeated rows and ids are kept as they are.
    """
    k = len(model.variances)

    @pandas_udf("deviation string, white array<double>")
    def applied(x: pd.Series) -> pd.DataFrame:
        if not len(x) or not k:
            return pd.DataFrame({"deviation": ["0"] * len(x), "white": [[]] * len(x)})
        centred = model.centred(np.stack(x.to_list()))
        return pd.DataFrame({
            "deviation": [str(d) for d in model.deviation(centred)], "white": list(model.white(centred)),
        })

    share = [float(v / model.trace) for v in model.variances] if k else []
    shares = F.array(*map(F.lit, share)) if share else F.array().cast("array<double>")
    scored = rows.select("row", applied("x").alias("found"))
    long = scored.select(
        "row", F.col("found.deviation").cast("decimal(38,0)").alias("deviation"),
        F.posexplode("found.white").alias("place", "whitened"),
    )
    return long.select(
        "row", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.element_at(shares, F.col("place") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )

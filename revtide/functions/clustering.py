"""Expressions for laying out a table along several columns at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_of(column: Column, bounds: Sequence, first: int = 0) -> Column:
    """Number of sorted ``bounds`` that are not above the value, as a balanced tree of comparisons.

    Nulls go to the first bucket.
    """
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(
        column >= F.lit(bounds[middle]), bucket_of(column, bounds[middle + 1:], first + middle + 1)
    ).otherwise(bucket_of(column, bounds[:middle], first))


def interleave_bits(buckets: Sequence[Column], bits: int) -> Column:
    """One long made of the bits of all buckets, highest bits first and taking turns."""
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for position, bucket in enumerate(buckets):
            picked = F.shiftright(bucket.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            target = bit * len(buckets) + len(buckets) - 1 - position
            key = key.bitwiseOR(F.shiftleft(picked, target))
    return key

"""Conditional expressions that map values to categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def standardize(col: Column, keep: Sequence[str], other: str) -> Column:
    """Keep the listed values; anything else, null included, becomes ``other``."""
    return F.when(col.isin(*keep), col).otherwise(F.lit(other))


def bucketize(
    col: Column, edges: Sequence[float], labels: Sequence[str], other: str
) -> Column:
    """Name the half-open interval ``[edges[i], edges[i + 1])`` a value lies in.

    The last interval also holds its upper edge.  Null, NaN and values outside
    the edges become ``other``: every test has an upper bound, so NaN, which
    Spark orders above all numbers, passes none of them.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("edges must hold one value more than labels")
    value = col.cast("double")
    last = len(labels) - 1
    bucket = None
    for i, label in enumerate(labels):
        below = value <= edges[i + 1] if i == last else value < edges[i + 1]
        test = (value >= edges[i]) & below
        bucket = (
            F.when(test, F.lit(label))
            if bucket is None
            else bucket.when(test, F.lit(label))
        )
    return bucket.otherwise(F.lit(other))

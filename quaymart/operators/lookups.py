"""Build key-to-value lookups from several sources and map rows through them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaymart.functions import quoted
from quaymart.operators.labels import broadcast_if_small


def clean_lookup(df: DataFrame, placeholder: str | None = "None") -> DataFrame:
    """Drop rows with a null in any column, or the text a null was written as."""
    for name in df.columns:
        value = F.col(quoted(name))
        df = df.where(value.isNotNull())
        if placeholder is not None:
            df = df.where(value.cast("string") != placeholder)
    return df


def merge_lookups(lookups: Sequence[DataFrame]) -> DataFrame:
    """Distinct rows of all lookups, with columns matched by name."""
    return reduce(DataFrame.unionByName, lookups).distinct()


def one_value_per_key(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """The smallest value of each key, so the result has one row per key.

    Keys with several values are not told apart by anything in the lookup; the
    smallest is a choice that does not change from run to run.
    """
    return lookup.groupBy(F.col(quoted(key))).agg(F.min(quoted(value)).alias(value))


def ambiguous_keys(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value, and how many they have."""
    return (
        lookup.groupBy(F.col(quoted(key)))
        .agg(F.count_distinct(quoted(value)).alias("num_values"))
        .where(F.col("num_values") > 1)
    )


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The first row of each key under an order that should leave no ties.

    The filter on the row number lets Spark keep one row per key in each task
    before the shuffle, so a key with very many rows is no bottleneck.
    """
    rank = F.row_number().over(Window.partitionBy(*map(quoted, keys)).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def map_through(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Add the lookup's columns; rows whose key it lacks are dropped.

    ``lookup`` must have one row per key.  It is broadcast when measured small,
    so it is read twice: pass a stored table rather than a long plan.
    """
    return df.join(broadcast_if_small(lookup), key, "inner")

"""Label joins: add the columns of code tables to coded rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from quaymart.functions import quoted

# Lookups within both bounds are sent to every executor; all lookups of a table share them.
MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# A key with this share of all rows, or more, is hot: there are at most 100 of them.
HOT_SHARE = 0.01


class InvalidLookup(ValueError):
    """A lookup whose key is not one row per value."""


def _text_bytes(df: DataFrame):
    """Bytes of a row's values written as text."""
    return sum(
        (
            F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
            for c in df.columns
        ),
        F.lit(0),
    )


def broadcast_if_small(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Mark a table for broadcast after measuring that it is within both bounds.

    The measure is one aggregate over the table, which should be cheap to read:
    store a derived table first.  A larger table is returned unmarked: the planner
    then joins by shuffle, and splits skewed keys.
    """
    size = df.agg(
        F.count("*").alias("rows"),
        F.sum(_text_bytes(df).cast("long")).alias("bytes"),
    ).first()
    small = size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes
    return F.broadcast(df) if small else df


def prepare_lookups(
    lookups: Mapping[str, DataFrame], types: Mapping[str, DataType]
) -> dict[str, DataFrame]:
    """Check that each lookup has one row per key and broadcast the small ones.

    ``lookups`` is keyed by the key column, which is cast to its type in
    ``types`` if there is one.  All lookups are measured in one job, and the smallest are
    broadcast as long as all of these together are within the bounds.  A null key,
    a key that is not of its type or a key that occurs twice raises
    :class:`InvalidLookup`: joining it would lose labels or multiply rows.
    """
    typed, small = _measured(lookups, types)
    return {key: F.broadcast(df) if key in small else df for key, df in typed.items()}


def _measured(
    lookups: Mapping[str, DataFrame], types: Mapping[str, DataType]
) -> tuple[dict[str, DataFrame], set[str]]:
    """The checked lookups, and which of them to broadcast."""
    typed = {
        key: lookup.withColumn(key, F.col(key).try_cast(types[key]))
        if key in types
        else lookup
        for key, lookup in lookups.items()
    }
    stacked = reduce(
        DataFrame.unionByName,
        [
            lookup.select(
                F.lit(key).alias("key"),
                F.col(key).cast("string").alias("value"),
                _text_bytes(lookup).cast("long").alias("bytes"),
            )
            for key, lookup in typed.items()
        ],
    )
    measured = (
        stacked.groupBy("key", "value")
        .agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes"))
        .groupBy("key")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum(F.when(F.col("value").isNotNull(), F.col("rows"))).alias("keyed"),
            F.count("value").alias("distinct"),
            F.sum("bytes").alias("bytes"),
        )
    )
    sizes = []
    for found in measured.na.fill(0).collect():
        key = found["key"]
        if found["keyed"] < found["rows"]:
            bad = found["rows"] - found["keyed"]
            raise InvalidLookup(f"{bad} rows without a usable {key}")
        if found["distinct"] < found["keyed"]:
            bad = found["keyed"] - found["distinct"]
            raise InvalidLookup(f"{bad} rows repeat a {key}")
        sizes.append((found["bytes"], found["rows"], key))
    small, all_rows, all_bytes = set(), 0, 0
    for size, rows, key in sorted(sizes):
        all_rows, all_bytes = all_rows + rows, all_bytes + size
        if all_rows <= MAX_BROADCAST_ROWS and all_bytes <= MAX_BROADCAST_BYTES:
            small.add(key)
    return typed, small


def hot_values(
    df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE
) -> dict[str, list[str]]:
    """Values of each key column that at least ``share`` of all rows have, as text.

    All columns are counted in one pass over these columns alone, in each task before the
    shuffle; at most ``1 / share`` values a column are collected.  Nulls are left out, as
    they join nothing.
    """
    if not keys:
        return {}
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(k).alias("key"), F.col(quoted(k)).cast("string").alias("value"))
                    for k in keys
                ]
            )
        )
    )
    counted = pairs.groupBy("key", "value").agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    found = counted.where(F.col("value").isNotNull() & (F.col("n") >= share * total)).collect()
    hot: dict[str, list[str]] = {k: [] for k in keys}
    for row in sorted(found, key=lambda r: r["value"]):
        hot[row["key"]].append(row["value"])
    return hot


def join_hot(
    df: DataFrame, lookup: DataFrame, key: str, hot: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join on a key some values of which have very many rows.

    Rows of :func:`hot_values` meet their few lookup rows by broadcast, if these are
    measured small, and stay in the tasks they are in; all others are shuffled.  No row is
    salted or copied, so a task that runs again gives the same rows.  The table is read
    once for either part, with its filter pushed down.
    """
    if not hot:
        return df.join(lookup, key, how)

    def is_hot(side: DataFrame):
        kind = side.schema[key].dataType
        values = [F.lit(v).cast(kind) for v in hot]
        return F.coalesce(F.col(quoted(key)).isin(*values), F.lit(False))

    few = broadcast_if_small(lookup.where(is_hot(lookup)))
    many = lookup.where(~is_hot(lookup))
    return (
        df.where(is_hot(df))
        .join(few, key, how)
        .unionByName(df.where(~is_hot(df)).join(many, key, how))
    )


def join_labels(
    df: DataFrame,
    lookups: Mapping[str, DataFrame],
    types: Mapping[str, DataType],
    how: str = "left",
) -> DataFrame:
    """:func:`prepare_lookups` and :func:`with_labels`, and hot keys of lookups too large.

    Only where a lookup is beyond the broadcast are the keys of ``df`` counted.
    """
    typed, small = _measured(lookups, types)
    large = [k for k in typed if k not in small and k in df.columns]
    prepared = {key: F.broadcast(t) if key in small else t for key, t in typed.items()}
    return with_labels(df, prepared, how, hot_values(df, large))


def with_labels(
    df: DataFrame,
    lookups: Mapping[str, DataFrame],
    how: str = "left",
    hot: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Join each lookup on the column it is keyed by, in the given order.

    A later lookup may be keyed by a column an earlier one added.  Rows without
    a match keep null labels under ``left``.  The join strategy is the planner's,
    from the lookup's measured size or the mark :func:`prepare_lookups` set; ``hot``
    names values to :func:`join_hot` for a key.
    """
    for key, lookup in lookups.items():
        df = join_hot(df, lookup, key, (hot or {}).get(key, ()), how)
    return df

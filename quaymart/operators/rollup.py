"""Grouped roll-ups that need one pass over their input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymart.functions import quoted


def rollup(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """All measures of a group in one aggregate, each under its given name.

    One scan and, without distinct counts, one shuffle of partial sums, however
    many measures there are.  Rows with a null key form a group of their own.
    """
    by = [F.col(quoted(k)) for k in keys]
    return df.groupBy(*by).agg(*[m.alias(name) for name, m in measures.items()])


def _filled(total: Column, fill_zero: bool) -> Column:
    return F.coalesce(total, F.lit(0)) if fill_zero else total


def counts_by_category(
    category: str, names: Mapping[str, str], fill_zero: bool = False
) -> dict[str, Column]:
    """Rows per category as measures for :func:`rollup`: ``{value: new name}``.

    The values are given, so no job has to look for them and a value absent from
    the data still gets its column.  Without any row the count is null, or 0
    with ``fill_zero``.
    """
    return {
        name: _filled(F.sum(F.when(F.col(category) == value, 1)), fill_zero)
        for value, name in names.items()
    }


def sums_by_category(
    category: str, amount: str, names: Mapping[str, str], fill_zero: bool = False
) -> dict[str, Column]:
    """Sum of an amount per category as measures for :func:`rollup`."""
    return {
        name: _filled(
            F.sum(F.when(F.col(category) == value, F.col(amount))), fill_zero
        )
        for value, name in names.items()
    }


def distinct_counts(
    df: DataFrame, keys: Sequence[str], column: str, name: str
) -> DataFrame:
    """Exact number of distinct non-null values per group.

    To be joined to a :func:`rollup` that has a quantile.  In one aggregate Spark
    would group by the distinct column too and keep a quantile sketch for each of
    its values; apart, the sketches stay one per group and task, and the
    distinct values are de-duplicated in each task before the shuffle.
    """
    pairs = df.select(*keys, column).distinct()
    return pairs.groupBy(*keys).agg(F.count(column).alias(name))


def header_detail_rollup(
    df: DataFrame,
    header: Sequence[str],
    keys: Sequence[str],
    header_sums: Mapping[str, Column],
    detail_sums: Mapping[str, Column],
) -> DataFrame:
    """Roll up a table whose header columns repeat on every detail row.

    ``header_sums`` are expressions over one header row and count each distinct
    header once; ``detail_sums`` are sums over all detail rows.  The input is
    grouped by the whole header first, which removes the repeats and adds up the
    details in the same shuffle, then by the keys.  Splitting it into a header
    and a detail table would scan it twice and need a join.
    """
    per_header = df.groupBy(*[F.col(f"`{c}`") for c in header]).agg(
        *[total.alias(name) for name, total in detail_sums.items()]
    )
    headers = per_header.select(
        *[F.col(f"`{k}`") for k in keys],
        *[value.alias(name) for name, value in header_sums.items()],
        *detail_sums,
    )
    return headers.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        *[F.sum(name).alias(name) for name in [*header_sums, *detail_sums]]
    )


def join_measures(
    base: DataFrame, frames: Sequence[DataFrame], keys: Sequence[str]
) -> DataFrame:
    """Attach measures of other origin to a base with the same keys.

    Every frame has one row per key, so nothing multiplies; keys a frame lacks
    get null measures.  Measures of the *same* input belong in one
    :func:`rollup` instead.
    """
    for frame in frames:
        base = base.join(frame, list(keys), "left")
    return base

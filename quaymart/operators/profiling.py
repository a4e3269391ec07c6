"""Profiles of a table, each in one pass over it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaymart.functions import percentage, quoted


def _quoted(name: str) -> Column:
    return F.col(quoted(name))


def _as_text(df: DataFrame, name: str) -> Column:
    """A value as text; a negative zero is zero."""
    value = _quoted(name)
    if dict(df.dtypes)[name] in ("float", "double"):
        value = value + F.lit(0.0).cast(dict(df.dtypes)[name])
    return value.cast("string")


def _one_row_each(
    df: DataFrame, columns: Sequence[str], facts: Mapping[str, object]
) -> DataFrame:
    """Aggregate ``facts`` of all columns at once and give one row per column.

    ``facts`` maps an output name to a function from a column to an aggregate.
    The aggregate has a single wide row; turning it on its side is free.
    """
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                *[fact(_quoted(c)).alias(name) for name, fact in facts.items()],
            ).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    return wide.select(F.inline(F.array(*[f"_{i}" for i in range(len(columns))])))


def null_profile(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Rows, nulls and percentage of nulls per column."""
    counted = _one_row_each(
        df,
        columns or df.columns,
        {
            "row_count": lambda c: F.count("*"),
            "null_count": lambda c: F.count_if(c.isNull()),
        },
    )
    return counted.withColumn(
        "null_percent", percentage(F.col("null_count"), F.col("row_count"))
    )


def column_info(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Type and number of non-null values per column."""
    columns = columns or df.columns
    types = F.create_map(
        *[F.lit(x) for name, kind in df.dtypes if name in columns for x in (name, kind)]
    )
    counted = _one_row_each(df, columns, {"non_null_count": F.count})
    return counted.select(
        "column_name",
        F.element_at(types, F.col("column_name")).alias("data_type"),
        "non_null_count",
    )


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum per column."""
    return _one_row_each(
        df,
        columns,
        {
            "value_count": F.count,
            "mean": F.avg,
            "stddev": F.stddev_samp,
            "min": lambda c: F.min(c.cast("double")),
            "max": lambda c: F.max(c.cast("double")),
        },
    )


def span(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value of each column, in one row."""
    return df.agg(
        *[
            extreme(_quoted(c)).alias(f"{prefix}_{c}")
            for c in columns
            for prefix, extreme in (("min", F.min), ("max", F.max))
        ]
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency of every value of every listed column, nulls included.

    Values are shown as text.  Each row is turned into one pair per column, and
    the pairs are counted before they are shuffled.
    """
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        _as_text(df, c).alias("value"),
                    )
                    for c in columns
                ]
            )
        )
    )
    return pairs.groupBy("column_name", "value").agg(F.count("*").alias("row_count"))


def distinct_profile(
    df: DataFrame, columns: Sequence[str], sample: int = 5
) -> DataFrame:
    """Number of distinct values per column, null counted as one, and a sample.

    The sample is the first ``sample`` values in text order with their
    frequencies, the same in every run; each task drops the values beyond it
    before the shuffle.  Counts and sample share one scan: both are built from
    the same counted values.
    """
    values = value_counts(df, columns)
    in_order = Window.partitionBy("column_name").orderBy(F.asc_nulls_last("value"))
    sampled = (
        values.withColumn("_rank", F.row_number().over(in_order))
        .where(F.col("_rank") <= sample)
        .groupBy("column_name")
        .agg(
            F.sort_array(F.collect_list(F.struct("value", "row_count"))).alias(
                "sample_values"
            )
        )
    )
    counted = values.groupBy("column_name").agg(
        F.count("*").alias("distinct_count"), F.sum("row_count").alias("row_count")
    )
    return counted.join(sampled, "column_name")


def attribute_variants(
    df: DataFrame, keys: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """Every distinct combination of key and attributes, in key order."""
    columns = [_quoted(c) for c in (*keys, *attributes)]
    return df.select(*columns).distinct().orderBy(*columns)


def unstable_keys(
    df: DataFrame, keys: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """Keys whose attributes are not always the same, and how many variants."""
    return (
        df.select(*[_quoted(c) for c in (*keys, *attributes)])
        .distinct()
        .groupBy(*[_quoted(c) for c in keys])
        .agg(F.count("*").alias("num_variants"))
        .where(F.col("num_variants") > 1)
    )


def schema_difference(left: DataFrame, right: DataFrame) -> dict[str, list[str]]:
    """Columns only one of two tables has, and those whose types differ."""
    a, b = dict(left.dtypes), dict(right.dtypes)
    return {
        "only_left": [c for c in a if c not in b],
        "only_right": [c for c in b if c not in a],
        "type_differs": [c for c in a if c in b and a[c] != b[c]],
    }


def membership_flags(
    base: DataFrame, key: str, others: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Distinct keys of a table with a 1/0 flag per other table that has the key.

    ``others`` maps a flag name to ``(table, column)``.  All keys are tagged with
    their origin, stacked and grouped once, so the number of tables adds no join
    and no shuffle, and a key with very many rows shrinks to one row per task
    first.  A null key matches nothing.
    """
    names = list(others)

    def tagged(values: Column, origin: str | None) -> list[Column]:
        return [
            values.alias(key),
            F.lit(1 if origin is None else 0).alias("_base"),
            *[F.lit(1 if origin == n else 0).alias(n) for n in names],
        ]

    stacked = [base.select(*tagged(_quoted(key), None))]
    for name, (table, column) in others.items():
        values = table.select(_quoted(column).alias(key)).where(F.col(key).isNotNull())
        stacked.append(values.select(*tagged(F.col(key), name)))
    return (
        reduce(DataFrame.unionByName, stacked)
        .groupBy(key)
        .agg(*[F.max(n).alias(n) for n in ["_base", *names]])
        .where(F.col("_base") == 1)
        .drop("_base")
    )


def coverage_totals(flags: DataFrame, names: Sequence[str]) -> DataFrame:
    """Number of keys and number of keys found per flag, in one row."""
    return flags.agg(
        F.count("*").alias("total_keys"), *[F.sum(n).alias(n) for n in names]
    )


def matched_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``; repeats in ``left`` stay."""
    return left.join(right.select(key).distinct(), key, "left_semi")

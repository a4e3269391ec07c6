"""A profile of tables with many columns and many values: sketches first, then exact counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymart.functions import quoted

#: Size of the distinct sketches as a power of two; one standard error is 0.8 %.
DISTINCT_SIZE = 14
#: How far an estimate may be off before a column is taken for exact counting: six errors.
MARGIN = 1.05
#: Rows of candidates that may be broadcast.
BROADCAST_ROWS = 500_000
_SIMPLE = ("string", "boolean", "date", "timestamp", "timestamp_ntz", "binary")
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def wide_profile(
    df: DataFrame,
    columns: Sequence[str] = (),
    one_in: int = 100,
    few: int = 1000,
    unique_percent: int = 99,
) -> DataFrame:
    """Rows, nulls, distinct values and frequent values per column.

    ``distinct_estimate`` comes from a HyperLogLog sketch.  ``distinct_count`` is exact and
    given for columns of at most ``few`` values and for those of which ``unique_percent`` of
    all filled rows, or more, are different (possible keys); else it is null.
    ``frequent_values`` holds every value that at least one of ``one_in`` rows has, with exact
    counts, most frequent first, then in text order.

    The first scan makes two sketches of bounded size a column and shuffles no values.  The
    frequent-items sketch has a slot count that returns every value of that share, and others.
    The second scan counts only these candidates and the columns whose estimate is near a
    bound; columns without either are not read again.  The driver reads a row a column, with
    at most ``8 * one_in`` hashes.  Nulls are no values, both zeros are one, NaN is a value;
    nested values go by their text.  An empty table has zeros and no frequent values.
    """
    columns = list(columns or df.columns)
    first = _sketched(df, columns, one_in)
    total = max((r["row_count"] for r in first), default=0)
    exact, candidates = set(), []
    for row in first:
        name, near = row["column_name"], row["distinct_estimate"]
        filled = row["row_count"] - row["null_count"]
        if near <= few * MARGIN or near * MARGIN * 100 >= unique_percent * filled:
            exact.add(name)
        candidates += [(name, item) for item in row["candidates"]]
    spark = df.sparkSession
    facts = spark.createDataFrame(
        [
            (r["column_name"], r["row_count"], r["null_count"], r["distinct_estimate"],
             r["column_name"] in exact)
            for r in first
        ],
        "column_name string, row_count long, null_count long, distinct_estimate long, "
        "_exact boolean",
    )
    held = spark.createDataFrame(candidates, "column_name string, _hash long")
    if len(candidates) <= BROADCAST_ROWS:
        held = F.broadcast(held)
    again = [c for c in columns if c in exact or any(c == name for name, _ in candidates)]
    counted = _counted(df, again, exact, held, one_in, total)
    distinct = F.when(F.col("_exact"), F.coalesce("_distinct", F.lit(0)))
    shown = (distinct <= few) | (
        distinct * 100 >= (F.col("row_count") - F.col("null_count")) * unique_percent
    )
    none = F.array().cast("array<struct<value:string,row_count:bigint>>")
    return facts.join(F.broadcast(counted), "column_name", "left").select(
        "column_name",
        "row_count",
        "null_count",
        "distinct_estimate",
        F.when(shown, distinct).alias("distinct_count"),
        F.coalesce("_frequent", none).alias("frequent_values"),
    )


def _value(df: DataFrame, name: str) -> Column:
    """A value as it is counted: a negative zero is zero."""
    kind = dict(df.dtypes)[name]
    value = F.col(quoted(name))
    return value + F.lit(0).cast(kind) if kind in ("float", "double") else value


def _hash(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    value = _value(df, name)
    simple = kind in _SIMPLE or kind in _NUMBERS or kind.startswith("decimal")
    return F.when(value.isNotNull(), F.xxhash64(value if simple else value.cast("string")))


def _sketched(df: DataFrame, columns: Sequence[str], one_in: int) -> list:
    """One row a column from one scan: its counts, its estimate, hashes that may be frequent.

    With ``m`` slots a value of more than ``7 * rows / m`` rows is always among the items.
    """
    slots = 1 << (8 * one_in - 1).bit_length()
    tracked = F.lit(slots * 3 // 4)
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count("*").alias("row_count"),
                F.count_if(F.col(quoted(c)).isNull()).alias("null_count"),
                F.hll_sketch_estimate(F.hll_sketch_agg(_hash(df, c), DISTINCT_SIZE)).alias(
                    "distinct_estimate"
                ),
                F.call_function("approx_top_k", _hash(df, c), tracked, tracked).alias("items"),
            ).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    each = wide.select(F.inline(F.array(*[f"_{i}" for i in range(len(columns))])))
    # The count of an item is never below the true one, so nothing frequent goes here.
    possible = F.filter(
        "items",
        lambda x: x["item"].isNotNull() & (x["count"] * one_in >= F.col("row_count")),
    )
    return each.select(
        "column_name",
        "row_count",
        "null_count",
        "distinct_estimate",
        F.transform(possible, lambda x: x["item"]).alias("candidates"),
    ).collect()


def _counted(
    df: DataFrame,
    columns: Sequence[str],
    exact: set[str],
    held: DataFrame,
    one_in: int,
    total: int,
) -> DataFrame:
    """Distinct count and frequent values of some columns, from exact counts."""
    if not columns:
        return df.sparkSession.createDataFrame(
            [],
            "column_name string, _distinct long, "
            "_frequent array<struct<value:string,row_count:bigint>>",
        )
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        _hash(df, c).alias("_hash"),
                        _value(df, c).cast("string").alias("value"),
                        F.lit(c in exact).alias("_all"),
                    )
                    for c in columns
                ]
            )
        )
    ).where(F.col("_hash").isNotNull())
    wanted = pairs.join(
        held.withColumn("_candidate", F.lit(True)), ["column_name", "_hash"], "left"
    ).where(F.col("_all") | F.col("_candidate"))
    values = wanted.groupBy("column_name", "value").agg(
        F.count("*").alias("row_count"), F.max("_candidate").alias("_candidate")
    )
    frequent = F.col("_candidate") & (F.col("row_count") * one_in >= total)
    order = F.struct((-F.col("row_count")).alias("less"), "value", "row_count")
    # At most `one_in` values a column are frequent.
    return values.groupBy("column_name").agg(
        F.count("*").alias("_distinct"),
        F.transform(
            F.array_sort(F.collect_list(F.when(frequent, order))),
            lambda x: F.struct(x["value"], x["row_count"]),
        ).alias("_frequent"),
    )

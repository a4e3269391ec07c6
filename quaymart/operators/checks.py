"""Data-quality checks.  A check is a small report table; ``enforce`` acts on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.functions import quoted


class QualityError(ValueError):
    """A table that failed its checks."""


def table_checks(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Row count, distinct keys and the verdicts non-empty and unique, per table.

    Each table is read once and only its key columns are.  A key with a null in
    it is not counted as distinct, so null keys fail like repeated ones.
    """
    reports = [
        table.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            F.count_distinct(*[F.col(k) for k in keys[name]]).alias("distinct_keys"),
        )
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, reports).withColumns(
        {
            "non_empty": F.col("row_count") > 0,
            "unique_key": F.col("row_count") == F.col("distinct_keys"),
        }
    )


def reconcile(fact: DataFrame, measure: str, source: DataFrame) -> DataFrame:
    """Compare the sum of a fact's measure with the number of source rows."""
    return fact.agg(
        F.coalesce(F.sum(measure), F.lit(0)).cast("long").alias("fact_total"),
        source.agg(F.count("*")).scalar().alias("source_rows"),
    ).withColumn("reconciled", F.col("fact_total") == F.col("source_rows"))


def reconcile_totals(
    checks: Mapping[str, tuple[DataFrame, str, DataFrame]],
) -> DataFrame:
    """For each check, the sum of a fact's measure and the number of its source's rows.

    ``checks`` maps a name to ``(fact, measure, source)``.  All rows are stacked as amounts
    and summed in one shuffle of partial sums; every check has a row, also without data.
    """

    def amounts(df: DataFrame, name: str, fact, source) -> DataFrame:
        return df.select(
            F.lit(name).alias("check_name"),
            fact.cast("long").alias("fact_total"),
            source.cast("long").alias("source_rows"),
        )

    zero, one = F.lit(0), F.lit(1)
    stacked = []
    for name, (fact, measure, source) in checks.items():
        stacked += [
            amounts(fact, name, F.col(quoted(measure)), zero),
            amounts(source, name, zero, one),
            amounts(fact.sparkSession.range(1), name, zero, zero),
        ]
    return (
        reduce(DataFrame.unionByName, stacked)
        .groupBy("check_name")
        .agg(F.sum("fact_total").alias("fact_total"), F.sum("source_rows").alias("source_rows"))
        .withColumn("reconciled", F.col("fact_total") == F.col("source_rows"))
    )


@dataclass(frozen=True)
class Reference:
    """A column of a fact that should occur as the key of a dimension."""

    fact: str
    column: str
    dimension: str
    key: str


def orphans(
    tables: Mapping[str, DataFrame], references: Sequence[Reference]
) -> DataFrame:
    """Facts without their dimension row: rows, orphan rows, orphan keys and the verdict.

    Each table is read once, whatever the number of references.  Keys of facts and
    dimensions are stacked with the reference they belong to and grouped once, as text, so
    a key with a third of all rows is one row a task before the shuffle.  A null key of a
    fact is an orphan; every reference has a row, also without data.
    """

    def tagged(r: Reference, key, n: int, known: int):
        return F.struct(
            F.lit(r.fact).alias("fact_name"),
            F.lit(r.column).alias("column_name"),
            F.lit(r.dimension).alias("dimension_name"),
            key.cast("string").alias("key"),
            F.lit(n).cast("long").alias("n"),
            F.lit(known).alias("known"),
        )

    stacked = []
    for name, table in tables.items():
        facts = [tagged(r, F.col(quoted(r.column)), 1, 0) for r in references if r.fact == name]
        dimensions = [
            tagged(r, F.col(quoted(r.key)), 0, 1) for r in references if r.dimension == name
        ]
        if facts:
            stacked.append(table.select(F.inline(F.array(*facts))))
        if dimensions:
            keys = table.select(F.inline(F.array(*dimensions)))
            stacked.append(keys.where(F.col("key").isNotNull()))
    none = F.lit(None).cast("string")
    every = next(iter(tables.values())).sparkSession.range(1)
    stacked.append(every.select(F.inline(F.array(*[tagged(r, none, 0, 0) for r in references]))))
    names = ["fact_name", "column_name", "dimension_name"]
    orphan = (F.col("known") == 0) & (F.col("n") > 0)
    return (
        reduce(DataFrame.unionByName, stacked)
        .groupBy(*names, "key")
        .agg(F.sum("n").alias("n"), F.max("known").alias("known"))
        .groupBy(*names)
        .agg(
            F.sum("n").alias("row_count"),
            F.sum(F.when(orphan, F.col("n")).otherwise(0)).alias("orphan_rows"),
            F.count_if(orphan).alias("orphan_keys"),
        )
        .withColumn("complete", F.col("orphan_rows") == 0)
    )


def collected(report: DataFrame) -> DataFrame:
    """A report computed once: a few rows, kept as they are, that no later use computes again."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def enforce(report: DataFrame, verdicts: Sequence[str]) -> None:
    """Raise :class:`QualityError` naming every row of a report that failed.

    A report has one row per table, so collecting it is safe.
    """
    passed = reduce(lambda a, b: a & b, [F.col(v) for v in verdicts])
    failed = report.where(~F.coalesce(passed, F.lit(False))).collect()
    if failed:
        raise QualityError("; ".join(str(row.asDict()) for row in failed))

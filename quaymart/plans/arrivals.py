"""Traveller arrivals: labels, cleaning, the arrivals fact and two dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quaymart.functions import (
    bucketize,
    calendar_columns,
    composite_key,
    epoch_day_to_date,
    standardize,
)
from quaymart.operators import (
    counts_by_category,
    join_labels,
    rollup,
)
from quaymart.schemas import ARRIVALS, FACT_IMMIGRATION, MODE_LABELS, VISA_LABELS

# Code tables, categories and markers of the source files.
MODES = [("1", "Air"), ("2", "Sea"), ("3", "Land"), ("9", "Not Reported")]
VISAS = [("1", "Business"), ("2", "Pleasure"), ("3", "Student")]
MODE_COUNTS = {
    "Land": "land_travellers",
    "Sea": "sea_travellers",
    "Air": "air_travellers",
}
VISA_COUNTS = {
    "Business": "business_travellers",
    "Pleasure": "pleasure_travellers",
    "Student": "student_travellers",
}
AGE_EDGES = [0, 18, 30, 40, 50, 60, 120]
AGE_LABELS = [
    "Below 18",
    "18 to 29",
    "30 to 39",
    "40 to 49",
    "50 to 59",
    "60 and Above",
]
UNKNOWN_AGE = "Unknown"
GENDERS = ["M", "F"]
OTHER_GENDER = "O"
RELEVANT_PORT = "RELEVANT"
INVALID_CONTINENT = "INVALID"


def _code_table(
    spark: SparkSession, codes: list[tuple[str, str]], schema: StructType
) -> DataFrame:
    """A few fixed rows as a literal of the plan, which needs no scan."""
    pairs = [F.struct(*map(F.lit, pair)) for pair in codes]
    return spark.range(1).select(F.inline(F.array(*pairs))).toDF(*schema.fieldNames())


def mode_labels(spark: SparkSession) -> DataFrame:
    """The travel modes as a lookup, for callers without a file of them."""
    return _code_table(spark, MODES, MODE_LABELS)


def visa_labels(spark: SparkSession) -> DataFrame:
    """The visa types as a lookup, for callers without a file of them."""
    return _code_table(spark, VISAS, VISA_LABELS)


def label_arrivals(
    arrivals: DataFrame,
    modes: DataFrame,
    ports: DataFrame,
    visas: DataFrame,
    citizenship: DataFrame,
) -> DataFrame:
    """Cut arrivals to the columns in use and add the labels of all four codes.

    Arrivals may come as text, and keys of the code tables do; both are cast to
    the types of the arrivals.  A column ``file`` is kept.
    """
    types = {field.name: field.dataType for field in ARRIVALS.fields}
    file = ["file"] if "file" in arrivals.columns else []
    arrivals = arrivals.select(
        *[F.col(c).cast(t).alias(c) for c, t in types.items()], *file
    )
    lookups = {
        "i94mode": modes,
        "i94port": ports,
        "i94visa": visas,
        "i94cit": citizenship,
    }
    return join_labels(arrivals, lookups, types)


def clean_arrivals(labelled: DataFrame) -> DataFrame:
    """Keep valid arrivals and add date, gender, age category and profile.

    Arrivals at an irrelevant or unknown port, of an invalid or unknown
    citizenship, or without a date are dropped.
    """
    kept = labelled.where(
        (F.col("i94port_relevant") == RELEVANT_PORT)
        & (F.col("i94cit_continent") != INVALID_CONTINENT)
        & F.col("arrdate").isNotNull()
    )
    described = kept.withColumns(
        {
            "arrdateclean": epoch_day_to_date(F.col("arrdate")),
            "genderclean": standardize(F.col("gender"), GENDERS, OTHER_GENDER),
            "agecategory": bucketize(
                F.col("i94bir"), AGE_EDGES, AGE_LABELS, UNKNOWN_AGE
            ),
        }
    )
    # A day count that is no date (NaN) is a missing date as well.
    return described.where(F.col("arrdateclean").isNotNull()).withColumns(
        {
            "profile_id": composite_key(
                [
                    F.col("genderclean"),
                    (F.col("i94cit_continent"), 3),
                    (F.col("agecategory"), 2),
                    (F.col("i94cit_global_region"), 1),
                ]
            ),
            "month": F.month("arrdateclean"),
            "year": F.year("arrdateclean"),
        }
    )


def of_months(cleaned: DataFrame, months: Sequence[tuple[int, int]]) -> DataFrame:
    """Cleaned arrivals of the given years and months."""
    kept = cleaned.where(
        (F.col("year") * 12 + F.col("month")).isin([y * 12 + m for y, m in months])
    )
    # The first day lets the scan skip older files.
    return kept.where(F.col("arrdateclean") >= date(*min(months), 1)) if months else kept


def within(
    cleaned: DataFrame, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Cleaned arrivals of a range of days, both ends included.

    The test on the day lets the scan skip files and row groups outside it.
    """
    month = F.col("year") * 12 + F.col("month")
    if first is not None:
        cleaned = cleaned.where(
            (month >= first.year * 12 + first.month) & (F.col("arrdateclean") >= first)
        )
    if last is not None:
        cleaned = cleaned.where(
            (month <= last.year * 12 + last.month) & (F.col("arrdateclean") <= last)
        )
    return cleaned


def arrivals_fact(cleaned: DataFrame, fill_zero: bool = False) -> DataFrame:
    """Travellers per state, day and profile, in total, by mode and by purpose.

    A mode that is not reported counts in the total only.
    """
    keyed = cleaned.select(
        F.col("i94port_state").alias("state_id"),
        F.col("arrdateclean").alias("arrival_date"),
        "profile_id",
        "i94mode_label",
        "i94visa_label",
    )
    return rollup(
        keyed,
        FACT_IMMIGRATION.natural_key,
        {
            "all_travellers": F.count("*"),
            **counts_by_category("i94mode_label", MODE_COUNTS, fill_zero),
            **counts_by_category("i94visa_label", VISA_COUNTS, fill_zero),
        },
    )


def traveller_profiles(cleaned: DataFrame) -> DataFrame:
    """The distinct traveller profiles."""
    return cleaned.select(
        "profile_id",
        F.col("genderclean").alias("gender"),
        F.col("agecategory").alias("age_category"),
        F.col("i94cit_continent").alias("citizen_region"),
        F.col("i94cit_global_region").alias("citizen_global_region"),
    ).distinct()


def calendar(dated: DataFrame, column: str) -> DataFrame:
    """The distinct dates of a column with their parts.

    The arrivals fact holds the same dates as the arrivals in far fewer rows.
    """
    dates = dated.select(F.col(column).alias("timestamp")).distinct()
    return dates.select("timestamp", *[
        part.alias(name) for name, part in calendar_columns(F.col("timestamp")).items()
    ])

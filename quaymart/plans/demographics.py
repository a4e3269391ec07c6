"""City demographics: the demographics fact, the states and their cities.

The source repeats a city's figures on one row per race.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.functions import ratio
from quaymart.operators import header_detail_rollup, sums_by_category
from quaymart.schemas import DEMOGRAPHICS, FACT_DEMOGRAPHICS

# The races of the source file.
RACE_SUMS = {
    "Hispanic or Latino": "hispanic_pop",
    "White": "white_pop",
    "Asian": "asian_pop",
    "Black or African-American": "black_pop",
    "American Indian and Alaska Native": "native_pop",
}
HEADER = [c for c in DEMOGRAPHICS.fieldNames() if c not in ("Race", "Count")]


def demographic_cities(demographics: DataFrame) -> DataFrame:
    """The distinct cities with their state's name and id."""
    return demographics.select(
        "City", "State", F.col("State Code").alias("state_id")
    ).distinct()


def states(demographics: DataFrame) -> DataFrame:
    """The distinct states."""
    return demographics.select(
        F.col("State Code").alias("state_id"), F.col("State").alias("state_name")
    ).distinct()


def demographics_fact(demographics: DataFrame, fill_zero: bool = False) -> DataFrame:
    """Population, households and people per race of each state.

    A city's households are its population over its household size; a state's
    household size is its population over its households.  A city without a
    usable household size adds people but no households.
    """
    rolled = header_detail_rollup(
        demographics,
        header=HEADER,
        keys=["State Code"],
        header_sums={
            "total_pop": F.col("Total Population"),
            "male_pop": F.col("Male Population"),
            "female_pop": F.col("Female Population"),
            "veteran_pop": F.col("Number of Veterans"),
            "foreign_pop": F.col("Foreign-born"),
            "total_hh": ratio(
                F.col("Total Population"), F.col("Average Household Size")
            ),
        },
        detail_sums=sums_by_category("Race", "Count", RACE_SUMS, fill_zero),
    )
    return (
        rolled.withColumnRenamed("State Code", "state_id")
        .withColumn("avg_hh_size", ratio(F.col("total_pop"), F.col("total_hh")))
        .select(*FACT_DEMOGRAPHICS.columns)
    )

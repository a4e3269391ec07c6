"""City temperatures: mapped to states and summed up by year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.operators import (
    clean_lookup,
    distinct_counts,
    join_measures,
    map_through,
    merge_lookups,
    merge_sketches,
    one_value_per_key,
    rollup,
    sketch_quantile,
    value_sketches,
)
from quaymart.schemas import FACT_TEMPERATURE


def observations(temperatures: DataFrame, country: str = "United States") -> DataFrame:
    """Observations of a country that have a temperature."""
    return temperatures.where(F.col("Country") == country).na.drop(
        subset=["AverageTemperature"]
    )


def city_states(demographic_cities: DataFrame, port_cities: DataFrame) -> DataFrame:
    """Every pair of state and city in either lookup."""
    return merge_lookups(
        [
            clean_lookup(demographic_cities.select("state_id", "City")),
            clean_lookup(
                port_cities.select("state_id", F.col("municipality").alias("City"))
            ),
        ]
    )


def state_lookup(pairs: DataFrame) -> DataFrame:
    """One state per city.

    A city name in several states goes to the first state in alphabetical order;
    :func:`quaymart.operators.ambiguous_keys` lists these.
    """
    return one_value_per_key(pairs, "City", "state_id")


def map_states(observed: DataFrame, lookup: DataFrame) -> DataFrame:
    """Add the state to each observation; cities the lookup lacks are dropped."""
    return map_through(observed, lookup, "City")


def temperature_fact(mapped: DataFrame) -> DataFrame:
    """Yearly temperature figures of each state.

    The median is an observed temperature, exact for groups of up to about 5,000
    observations and within 1/10,000 of the group in rank beyond that.  The
    mapped observations are read twice and should be cheap to read.
    """
    keys = FACT_TEMPERATURE.natural_key
    temperature = F.col("AverageTemperature")
    yearly = mapped.withColumn("year", F.year("dt"))
    figures = rollup(
        yearly,
        keys,
        {
            "observation_count": F.count(temperature),
            "min_temp": F.min(temperature),
            "max_temp": F.max(temperature),
            "avg_temp": F.avg(temperature),
            "median_temp": F.percentile_approx(temperature, 0.5, 10_000),
        },
    )
    cities = distinct_counts(yearly, keys, "City", "num_of_cities")
    return join_measures(figures, [cities], keys)


def city_sketches(observed: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Mergeable figures of each city and year, and of each value of ``more`` columns.

    They name no state, so that cities are mapped anew at each merge.
    """
    yearly = observed.withColumn("year", F.year("dt"))
    return value_sketches(yearly, ["City", "year", *more], "AverageTemperature")


def merged_temperature_fact(sketches: DataFrame, lookup: DataFrame) -> DataFrame:
    """:func:`temperature_fact` from :func:`city_sketches` of any number of batches.

    Medians are observed temperatures, exact for groups of up to about
    :data:`quaymart.operators.SKETCH_SIZE` observations.
    """
    keys = list(FACT_TEMPERATURE.natural_key)
    by_city = merge_sketches(map_states(sketches, lookup), [*keys, "City"])
    merged = merge_sketches(by_city, keys, {"num_of_cities": F.count("*")})
    return merged.select(
        *keys,
        F.col("value_count").alias("observation_count"),
        F.col("lowest").alias("min_temp"),
        F.col("highest").alias("max_temp"),
        (F.col("total") / F.col("value_count")).alias("avg_temp"),
        sketch_quantile(0.5).alias("median_temp"),
        "num_of_cities",
    )

"""Transport ports: ports per state and type, and the cities they lie in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.functions import last_token
from quaymart.operators import rollup
from quaymart.schemas import FACT_PORTS


def country_ports(ports: DataFrame, country: str = "US") -> DataFrame:
    """Ports of a country whose region ends in a two-letter state."""
    located = ports.where(F.col("iso_country") == country).select(
        last_token(F.col("iso_region"), "-").alias("state_id"), "type", "municipality"
    )
    return located.where(F.length("state_id") == 2)


def ports_fact(ports: DataFrame) -> DataFrame:
    """Number of ports per state and type."""
    return rollup(
        ports.withColumnRenamed("type", "port_type"),
        FACT_PORTS.natural_key,
        {"num_of_ports": F.count("*")},
    )


def port_cities(ports: DataFrame) -> DataFrame:
    """The distinct pairs of state and city with a port."""
    return ports.select("state_id", "municipality").distinct()

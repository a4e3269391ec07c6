"""Input schemas and the contracts of the published tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MEASURE = DecimalType(18, 4)


def _struct(*columns: tuple) -> StructType:
    """Build a schema from ``(name, type)`` or ``(name, type, "required")``."""
    return StructType(
        [StructField(c[0], c[1], nullable=len(c) == 2) for c in columns]
    )


# ---------------------------------------------------------------- job inputs
# Column names of the public source files.

ARRIVALS = _struct(
    ("i94cit", DoubleType()),
    ("i94port", StringType()),
    ("arrdate", DoubleType()),
    ("i94mode", DoubleType()),
    ("i94visa", DoubleType()),
    ("i94bir", DoubleType()),
    ("gender", StringType()),
)

PORT_LABELS = _struct(
    ("i94port", StringType()),
    ("i94port_name", StringType()),
    ("i94port_state", StringType()),
    ("i94port_relevant", StringType()),
)

CITIZENSHIP_LABELS = _struct(
    ("i94cit", StringType()),
    ("i94cit_label", StringType()),
    ("i94cit_continent", StringType()),
    ("i94cit_global_region", StringType()),
)

MODE_LABELS = _struct(("i94mode", StringType()), ("i94mode_label", StringType()))
VISA_LABELS = _struct(("i94visa", StringType()), ("i94visa_label", StringType()))

PORTS = _struct(
    ("type", StringType()),
    ("iso_country", StringType()),
    ("iso_region", StringType()),
    ("municipality", StringType()),
)

DEMOGRAPHICS = _struct(
    ("City", StringType()),
    ("State", StringType()),
    ("Median Age", DoubleType()),
    ("Male Population", IntegerType()),
    ("Female Population", IntegerType()),
    ("Total Population", IntegerType()),
    ("Number of Veterans", IntegerType()),
    ("Foreign-born", IntegerType()),
    ("Average Household Size", DoubleType()),
    ("State Code", StringType()),
    ("Race", StringType()),
    ("Count", IntegerType()),
)

TEMPERATURES = _struct(
    ("dt", DateType()),
    ("AverageTemperature", DoubleType()),
    ("AverageTemperatureUncertainty", DoubleType()),
    ("City", StringType()),
    ("Country", StringType()),
    ("Latitude", StringType()),
    ("Longitude", StringType()),
)


# ---------------------------------------------------------- published tables


@dataclass(frozen=True)
class Table:
    """What a published table promises.

    ``schema`` fixes column order, types and which columns may not be null;
    ``key`` is unique and never null; ``partitions`` maps a directory column to
    the SQL expression that fills it (kept out of the table's own columns).
    """

    name: str
    schema: StructType
    key: str
    natural_key: tuple[str, ...]
    partitions: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


FACT_IMMIGRATION = Table(
    "fact_immigration",
    _struct(
        ("record_id", LongType(), "required"),
        ("state_id", StringType(), "required"),
        ("arrival_date", DateType(), "required"),
        ("profile_id", StringType(), "required"),
        ("all_travellers", IntegerType()),
        ("land_travellers", IntegerType()),
        ("sea_travellers", IntegerType()),
        ("air_travellers", IntegerType()),
        ("business_travellers", IntegerType()),
        ("pleasure_travellers", IntegerType()),
        ("student_travellers", IntegerType()),
    ),
    key="record_id",
    natural_key=("state_id", "arrival_date", "profile_id"),
    partitions={"month_": "month(arrival_date)", "year_": "year(arrival_date)"},
)

FACT_PORTS = Table(
    "fact_ports",
    _struct(
        ("record_id", LongType(), "required"),
        ("state_id", StringType(), "required"),
        ("port_type", StringType(), "required"),
        ("num_of_ports", IntegerType()),
    ),
    key="record_id",
    natural_key=("state_id", "port_type"),
)

# People are summed over all cities of a state, which an INTEGER may not hold.
FACT_DEMOGRAPHICS = Table(
    "fact_demographics",
    _struct(
        ("state_id", StringType(), "required"),
        ("total_pop", LongType()),
        ("male_pop", LongType()),
        ("female_pop", LongType()),
        ("veteran_pop", LongType()),
        ("foreign_pop", LongType()),
        ("hispanic_pop", LongType()),
        ("white_pop", LongType()),
        ("asian_pop", LongType()),
        ("black_pop", LongType()),
        ("native_pop", LongType()),
        ("avg_hh_size", MEASURE),
        ("total_hh", MEASURE),
    ),
    key="state_id",
    natural_key=("state_id",),
)

FACT_TEMPERATURE = Table(
    "fact_temperature",
    _struct(
        ("record_id", LongType(), "required"),
        ("state_id", StringType(), "required"),
        ("year", IntegerType(), "required"),
        ("observation_count", IntegerType()),
        ("num_of_cities", IntegerType()),
        ("min_temp", MEASURE),
        ("max_temp", MEASURE),
        ("avg_temp", MEASURE),
        ("median_temp", MEASURE),
    ),
    key="record_id",
    natural_key=("state_id", "year"),
    partitions={"year_": "year"},
)

DIM_STATE = Table(
    "dim_state",
    _struct(("state_id", StringType(), "required"), ("state_name", StringType())),
    key="state_id",
    natural_key=("state_id",),
)

DIM_DATETIME = Table(
    "dim_datetime",
    _struct(
        ("timestamp", DateType(), "required"),
        ("day", IntegerType(), "required"),
        ("month", IntegerType(), "required"),
        ("year", IntegerType(), "required"),
        ("month_year", StringType(), "required"),
        ("day_of_week", IntegerType()),
    ),
    key="timestamp",
    natural_key=("timestamp",),
    partitions={"month_": "month", "year_": "year"},
)

DIM_TRAVELLER_PROFILE = Table(
    "dim_traveller_profile",
    _struct(
        ("profile_id", StringType(), "required"),
        ("gender", StringType()),
        ("age_category", StringType()),
        ("citizen_region", StringType()),
        ("citizen_global_region", StringType()),
    ),
    key="profile_id",
    natural_key=("profile_id",),
)

TABLES = {
    table.name: table
    for table in (
        FACT_IMMIGRATION,
        FACT_PORTS,
        FACT_DEMOGRAPHICS,
        FACT_TEMPERATURE,
        DIM_STATE,
        DIM_DATETIME,
        DIM_TRAVELLER_PROFILE,
    )
}

"""Build, load and check all published tables, and query them.

Jobs hand tables to each other as Parquet below ``staging``; published tables
are written below ``output``, by default as Parquet, on request as CSV.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymart import schemas as S
from quaymart.operators import (
    Reference,
    collected,
    enforce,
    orphans,
    reconcile_totals,
    table_checks,
)
from quaymart.plans import arrivals, demographics, ports, temperature
from quaymart.sources import (
    Part,
    Version,
    commit,
    covers,
    find_version,
    land,
    load_parts,
    load_table,
    new_folder,
    publish,
    publish_table,
    read_batches,
    read_csv,
    read_csv_checked,
    read_lookup,
    read_parquet,
    register_tables,
    remove_old_versions,
    written_parts,
)


@dataclass(frozen=True)
class Paths:
    """Where the jobs read and write."""

    staging: str
    output: str
    output_format: str = "parquet"

    @property
    def arrivals(self) -> str:
        return f"{self.staging}/arrivals"

    @property
    def ports(self) -> str:
        return f"{self.staging}/ports"

    @property
    def port_cities(self) -> str:
        return f"{self.staging}/port_cities"

    @property
    def temperatures(self) -> str:
        return f"{self.staging}/temperature_sketches"

    @property
    def demographic_cities(self) -> str:
        return f"{self.staging}/demographic_cities"


def _publish(df: DataFrame, table: S.Table, paths: Paths) -> DataFrame:
    return publish_table(df, table, paths.output, paths.output_format)


def prepare_arrivals(
    spark: SparkSession,
    batches: Sequence[str],
    labels: dict[str, str],
    paths: Paths,
    file_format: str = "parquet",
    refresh: str = "all",
    rebalance: bool = False,
    schemas_differ: bool = False,
) -> DataFrame:
    """Label and clean all monthly files in one scan; store them by file.

    A ``refresh`` of ``batches`` replaces whatever came before from files that the given
    paths, folders and globs cover, also from files that are gone now, and keeps all other
    rows, also those of the same months; ``all`` starts anew.  Each version of the staged
    arrivals names its files and the months each has rows of.

    ``labels`` names the code files ``mode``, ``port``, ``visa`` and
    ``citizenship``.  A task reads few files and so writes few directories, without a
    shuffle; ask for a ``rebalance`` where there are many small files.
    """
    if refresh not in ("all", "batches"):
        raise ValueError(f"unknown refresh {refresh!r}")
    raw = read_batches(
        spark,
        batches,
        S.ARRIVALS.fieldNames(),
        file_format,
        schemas_differ=schemas_differ,
        file_column="file",
        **({"header": "true"} if file_format == "csv" else {}),
    )

    def lookup(name: str, schema) -> DataFrame:
        return read_lookup(spark, labels[name], schema.fieldNames())

    labelled = arrivals.label_arrivals(
        raw,
        modes=lookup("mode", S.MODE_LABELS),
        ports=lookup("port", S.PORT_LABELS),
        visas=lookup("visa", S.VISA_LABELS),
        citizenship=lookup("citizenship", S.CITIZENSHIP_LABELS),
    )
    now = find_version(spark, paths.arrivals)
    folder = new_folder()
    publish(
        arrivals.clean_arrivals(labelled),
        f"{paths.arrivals}/{folder}",
        partition_by={"batch": "concat('b-', sha2(file, 256))"},
        rebalance=rebalance,
    )
    added = _described(spark, paths, written_parts(spark, paths.arrivals, folder, True))
    kept = []
    if now and refresh == "batches":
        kept = [p for p in now.parts if not any(covers(b, p.about["file"]) for b in batches)]
    commit(spark, paths.arrivals, [*kept, *added], after=now)
    return staged_arrivals(spark, paths)


def _month(year, month):
    """Months in a row, as numbers."""
    return year * 12 + month - 1


def _described(spark: SparkSession, paths: Paths, parts: Sequence[Part]) -> list[Part]:
    """Parts of staged arrivals with their file and months; a row for each is collected."""
    if not parts:
        return []
    rows = (
        load_parts(spark, paths.arrivals, parts)
        .groupBy("file", F.concat(F.lit("batch=b-"), F.sha2("file", 256)).alias("part"))
        .agg(F.array_sort(F.collect_set(_month(F.col("year"), F.col("month")))).alias("months"))
        .collect()
    )
    about = {r["part"]: {"file": r["file"], "months": ",".join(map(str, r["months"]))} for r in rows}
    return [Part(p.part, p.folder, about[p.part]) for p in parts]


def staged_arrivals(
    spark: SparkSession, paths: Paths, months: Iterable[int] | None = None
) -> DataFrame:
    """Cleaned arrivals; with ``months`` those of files that have rows of one of them."""
    now = find_version(spark, paths.arrivals)
    if now is None:
        raise ValueError(f"no staged arrivals at {paths.arrivals}")
    wanted = None if months is None else set(months)
    parts = [p for p in now.parts if wanted is None or wanted & _months(p)]
    if not parts and now.parts:  # no file has such rows: the columns of any
        return load_parts(spark, paths.arrivals, now.parts[:1]).where(F.lit(False))
    return load_parts(spark, paths.arrivals, parts)


def _months(part: Part) -> set[int]:
    return {int(m) for m in part.about["months"].split(",")}


def _changed_months(before: Version, now: Version) -> set[int]:
    """Months with rows in what one version has and the other has not."""
    old, new = ({(p.part, p.folder): p for p in v.parts} for v in (before, now))
    return set().union(*(_months((old | new)[k]) for k in old.keys() ^ new.keys()))


def _directory(month: int) -> str:
    """The directory of a month in the arrivals fact and the calendar."""
    return f"month_={month % 12 + 1}/year_={month // 12}"


def build_arrivals(
    spark: SparkSession,
    paths: Paths,
    first: date | None = None,
    last: date | None = None,
    changes: bool = False,
) -> None:
    """Publish the arrivals fact, the traveller profiles and the dates.

    With ``changes`` only months are built anew of which staged files had or have rows
    that came, went or were replaced since the last such build, and with a ``first`` or
    ``last`` day the months from one to the other, both whole.  A month without rows is
    emptied.  Only files with rows of these months are read; profiles that are new there
    are added, others stay.  A build that was broken off is made good by the next one.
    """
    staged = find_version(spark, paths.arrivals)
    calendar = find_version(spark, f"{paths.output}/{S.DIM_DATETIME.name}")
    # The calendar is published last: it tells what the whole build has seen.
    seen = calendar and calendar.about.get("arrivals")
    about = {"arrivals": str(staged.number)} if staged else {}
    if (changes and not seen) or (first is None and last is None and not changes):
        cleaned = staged_arrivals(spark, paths)
        fact = publish_table(
            arrivals.arrivals_fact(cleaned), S.FACT_IMMIGRATION, paths.output, paths.output_format
        )
        _publish(arrivals.traveller_profiles(cleaned), S.DIM_TRAVELLER_PROFILE, paths)
        publish_table(
            arrivals.calendar(fact, "arrival_date"),
            S.DIM_DATETIME,
            paths.output,
            paths.output_format,
            about=about,
        )
        return

    months = set()
    if changes:
        months = _changed_months(find_version(spark, paths.arrivals, int(seen)), staged)
    else:
        about = dict(calendar.about) if calendar else {}
    if first is not None or last is not None:
        held = set().union(*map(_months, staged.parts))
        if calendar:
            names = [re.findall(r"\d+", p.part) for p in calendar.parts]
            held |= {_month(int(year), int(month)) for month, year in names}
        start = _month(first.year, first.month) if first else min(held, default=0)
        end = _month(last.year, last.month) if last else max(held, default=0)
        months |= {m for m in held if start <= m <= end}
    directories = [_directory(m) for m in sorted(months)]
    wanted = arrivals.of_months(
        staged_arrivals(spark, paths, months), [(m // 12, m % 12 + 1) for m in sorted(months)]
    )
    new = arrivals.traveller_profiles(wanted)
    if find_version(spark, f"{paths.output}/{S.DIM_TRAVELLER_PROFILE.name}"):
        known = load_table(spark, S.DIM_TRAVELLER_PROFILE, paths.output, paths.output_format)
        new = new.join(known.select("profile_id"), "profile_id", "left_anti")
    new = land(new, f"{paths.staging}/new_profiles")
    if not new.isEmpty():
        publish_table(
            new, S.DIM_TRAVELLER_PROFILE, paths.output, paths.output_format, refresh="append"
        )
    publish_table(
        arrivals.arrivals_fact(wanted),
        S.FACT_IMMIGRATION,
        paths.output,
        paths.output_format,
        refresh="partitions",
        directories=directories,
    )
    fact = load_table(
        spark, S.FACT_IMMIGRATION, paths.output, paths.output_format, directories
    )
    publish_table(
        arrivals.calendar(fact, "arrival_date"),
        S.DIM_DATETIME,
        paths.output,
        paths.output_format,
        refresh="partitions",
        directories=directories,
        about=about,
    )


def build_ports(spark: SparkSession, path: str, paths: Paths) -> None:
    """Publish the ports fact and store the cities with ports."""
    raw = read_csv(spark, path).select(*S.PORTS.fieldNames())
    kept = land(ports.country_ports(raw), paths.ports)
    _publish(ports.ports_fact(kept), S.FACT_PORTS, paths)
    land(ports.port_cities(kept), paths.port_cities)


def build_demographics(
    spark: SparkSession, path: str, paths: Paths, most_unreadable: int | None = None
) -> DataFrame:
    """Publish the demographics fact and the states, store the cities.

    Returns the unreadable rows, ``file, record``; they are left out, and are an error
    beyond ``most_unreadable``.
    """
    cities, unreadable = read_csv_checked(
        spark, path, S.DEMOGRAPHICS, f"{paths.staging}/demographics", ";", most=most_unreadable
    )
    _publish(demographics.demographics_fact(cities), S.FACT_DEMOGRAPHICS, paths)
    _publish(demographics.states(cities), S.DIM_STATE, paths)
    land(demographics.demographic_cities(cities), paths.demographic_cities)
    return unreadable


def _city_lookup(spark: SparkSession, paths: Paths) -> DataFrame:
    pairs = temperature.city_states(
        read_parquet(spark, paths.demographic_cities),
        read_parquet(spark, paths.port_cities),
    )
    return land(temperature.state_lookup(pairs), f"{paths.staging}/state_city_lookup")


def prepare_temperatures(
    spark: SparkSession, batches: Sequence[str], paths: Paths, refresh: str = "batches"
) -> DataFrame:
    """Store figures of each city, year and file that can be merged; returns those of all files.

    A ``refresh`` of ``batches`` replaces what came before from files that the given
    paths, folders and globs cover and reads no other file; ``all`` starts anew.
    """
    if refresh not in ("all", "batches"):
        raise ValueError(f"unknown refresh {refresh!r}")
    raw = read_csv(spark, list(batches), schema=S.TEMPERATURES, date_format="yyyy-MM-dd")
    now = find_version(spark, paths.temperatures)
    folder = new_folder()
    publish(
        temperature.city_sketches(
            temperature.observations(raw.withColumn("file", F.input_file_name())), ["file"]
        ),
        f"{paths.temperatures}/{folder}",
        partition_by={"batch": "concat('b-', sha2(file, 256))"},
    )
    parts = written_parts(spark, paths.temperatures, folder, True)
    files = {}
    if parts:
        staged = load_parts(spark, paths.temperatures, parts).select("file").distinct()
        named = staged.select("file", F.concat(F.lit("batch=b-"), F.sha2("file", 256)).alias("part"))
        files = {r["part"]: r["file"] for r in named.collect()}
    added = [Part(p.part, p.folder, {"file": files[p.part]}) for p in parts]
    kept = []
    if now and refresh == "batches":
        kept = [p for p in now.parts if not any(covers(b, p.about["file"]) for b in batches)]
    commit(spark, paths.temperatures, [*kept, *added], after=now)
    return load_parts(spark, paths.temperatures, [*kept, *added], _SKETCHES)


_SKETCHES = (
    "City string, year int, file string, value_count long, total double, lowest double, "
    "highest double, sketch binary"
)


def refresh_temperature(
    spark: SparkSession, batches: Sequence[str], paths: Paths, refresh: str = "batches"
) -> None:
    """Add or replace files of observations and publish the fact from the figures of all.

    Cities are mapped by the lookups as they are now, also those of files read before.
    """
    sketches = prepare_temperatures(spark, batches, paths, refresh)
    fact = temperature.merged_temperature_fact(sketches, _city_lookup(spark, paths))
    _publish(fact, S.FACT_TEMPERATURE, paths)


def build_temperature(spark: SparkSession, path: str, paths: Paths) -> None:
    """Publish the temperature fact; needs the city lookups of two other jobs.

    The mapped observations are a small part of the raw text and are stored, so
    that the text is parsed once.
    """
    raw = read_csv(spark, path, schema=S.TEMPERATURES, date_format="yyyy-MM-dd")
    lookup = _city_lookup(spark, paths)
    mapped = land(
        temperature.map_states(temperature.observations(raw), lookup).select(
            "state_id", "City", "dt", "AverageTemperature"
        ),
        f"{paths.staging}/temperatures",
    )
    _publish(temperature.temperature_fact(mapped), S.FACT_TEMPERATURE, paths)


def check_tables(
    spark: SparkSession, paths: Paths, names: Sequence[str] = tuple(S.TABLES)
) -> DataFrame:
    """Check that every table has rows and a unique key; raise if one fails.

    The report is computed once and returned as its rows.
    """
    report = collected(
        table_checks(
            {
                n: load_table(spark, S.TABLES[n], paths.output, paths.output_format)
                for n in names
            },
            {n: [S.TABLES[n].key] for n in names},
        )
    )
    enforce(report, ["non_empty", "unique_key"])
    return report


def check_totals(
    spark: SparkSession, paths: Paths, names: Sequence[str] = ("arrivals", "ports")
) -> DataFrame:
    """Check that the facts count every cleaned arrival and port; raise if not."""
    known = {
        "arrivals": lambda: (S.FACT_IMMIGRATION, "all_travellers", staged_arrivals(spark, paths)),
        "ports": lambda: (S.FACT_PORTS, "num_of_ports", read_parquet(spark, paths.ports)),
    }
    checks = {}
    for name in names:
        contract, measure, source = known[name]()
        fact = load_table(spark, contract, paths.output, paths.output_format)
        checks[name] = (fact, measure, source)
    report = collected(reconcile_totals(checks))
    enforce(report, ["reconciled"])
    return report


def check_arrivals(spark: SparkSession, paths: Paths) -> DataFrame:
    """Check that the arrivals fact counts every cleaned arrival; raise if not."""
    return check_totals(spark, paths, ["arrivals"])


#: Columns of facts and the dimensions they point to.  States come from sources of their
#: own, so a fact may have one that the dimension lacks; dates and profiles are built from
#: the fact's own rows and must be there.
REFERENCES = (
    Reference("fact_immigration", "state_id", "dim_state", "state_id"),
    Reference("fact_immigration", "arrival_date", "dim_datetime", "timestamp"),
    Reference("fact_immigration", "profile_id", "dim_traveller_profile", "profile_id"),
    Reference("fact_ports", "state_id", "dim_state", "state_id"),
    Reference("fact_demographics", "state_id", "dim_state", "state_id"),
    Reference("fact_temperature", "state_id", "dim_state", "state_id"),
)
REQUIRED = ("dim_datetime", "dim_traveller_profile")


def check_references(
    spark: SparkSession,
    paths: Paths,
    references: Sequence[Reference] = REFERENCES,
    required: Sequence[str] = REQUIRED,
) -> DataFrame:
    """Report facts without dimension rows; raise if a ``required`` dimension lacks one."""
    names = dict.fromkeys(n for r in references for n in (r.fact, r.dimension))
    tables = {
        n: load_table(spark, S.TABLES[n], paths.output, paths.output_format) for n in names
    }
    report = collected(orphans(tables, references))
    enforce(report.where(F.col("dimension_name").isin(*required)), ["complete"])
    return report


def remove_old(spark: SparkSession, paths: Paths, keep: int = 2) -> list[str]:
    """Delete what only versions before the last ``keep`` hold, of all tables."""
    tables = [paths.arrivals, paths.temperatures, *(f"{paths.output}/{n}" for n in S.TABLES)]
    return [f"{t}/{folder}" for t in tables for folder in remove_old_versions(spark, t, keep)]


# Travellers and foreign residents of each state next to their share of the
# country's.  The totals are scalar subqueries over the already grouped rows.
TRAVELLER_SHARE = """
WITH travellers AS (
    SELECT state_id, sum(all_travellers) AS state_total_travellers
    FROM fact_immigration
    GROUP BY state_id
)
SELECT
    t.state_id,
    t.state_total_travellers,
    d.foreign_pop AS state_foreign_pop,
    round(try_divide(CAST(t.state_total_travellers AS DOUBLE),
          (SELECT sum(state_total_travellers) FROM travellers)) * 100, 4)
        AS state_traveller_perc,
    round(try_divide(CAST(d.foreign_pop AS DOUBLE),
          (SELECT sum(foreign_pop) FROM fact_demographics)) * 100, 3)
        AS foreign_pop_perc
FROM travellers t
JOIN fact_demographics d ON t.state_id = d.state_id
WHERE t.state_total_travellers IS NOT NULL AND d.foreign_pop IS NOT NULL
ORDER BY state_foreign_pop DESC
"""


def traveller_share(
    spark: SparkSession, paths: Paths, names: Sequence[str] = tuple(S.TABLES)
) -> DataFrame:
    """Run the share query on the published tables."""
    register_tables(spark, paths.output, paths.output_format, names)
    return spark.sql(TRAVELLER_SHARE)

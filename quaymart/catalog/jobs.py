"""The star-schema jobs over tables put into the shape of their inputs.

An item sold stands for an arrival: the supplier is the port, the customer's
nation the citizenship, the ship date the arrival date, the order's priority and
status the mode and the visa.  Orders stand for cities, suppliers for ports, and
the roots of order prices for temperatures.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart import schemas as S
from quaymart.catalog.lookups import PAIRS_SQL, pairs
from quaymart.catalog.registry import Tables, query
from quaymart.functions import date_to_epoch_day, last_token
from quaymart.plans import arrivals, demographics, ports, temperature, warehouse
from quaymart.sources import land, load_table, publish, publish_table, staging_path


def sold_items(t: Tables) -> DataFrame:
    """Items with their order and its customer, cut to the columns in use.

    Where ``t`` has them stored (:func:`with_items`) they are not joined again.
    """
    if "sold" in vars(t):
        return t.sold
    customers = t.customer.select(
        "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"
    )
    orders = t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def with_items(t: Tables) -> Tables:
    """The same tables with the sold items joined once and stored."""
    stored = Tables(t.spark, t._folder)
    stored.sold = land(
        sold_items(t).select(
            "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_returnflag",
            "l_linestatus", "l_quantity", "o_orderkey", "o_orderdate", "o_orderpriority",
            "o_orderstatus", "o_totalprice", "c_nationkey", "c_mktsegment", "c_acctbal",
        ),
        staging_path(t.spark, "items"),
    )
    return stored


ITEMS_SQL = """items AS (
        SELECT * FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
    )"""


# ------------------------------------------------------------------ arrivals


# In some queries the last items of long orders have no date.
SHORT_ORDERS = "l_linenumber <> 7"


def raw_arrivals(t: Tables, dated: str | None = None) -> DataFrame:
    """Arrivals; with ``dated`` all others than those of this condition have no date."""
    day = date_to_epoch_day(F.col("l_shipdate"))
    priority = F.substring("o_orderpriority", 1, 1)
    mode = F.when(priority == "4", 9.0).when(priority != "5", priority.cast("double"))
    visa = (
        F.when(F.col("o_orderstatus") == "F", 1.0)
        .when(F.col("o_orderstatus") == "O", 2.0)
        .otherwise(3.0)
    )
    gender = (
        F.when(F.col("c_mktsegment") == "BUILDING", "M")
        .when(F.col("c_mktsegment") == "MACHINERY", "F")
        .otherwise("U")
    )
    return sold_items(t).select(
        F.col("c_nationkey").cast("double").alias("i94cit"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("i94port"),
        (day if dated is None else F.when(F.expr(dated), day)).alias("arrdate"),
        mode.alias("i94mode"),
        visa.alias("i94visa"),
        (F.col("c_acctbal") / 80).alias("i94bir"),
        gender.alias("gender"),
    )


def port_lookup(t: Tables) -> DataFrame:
    relevant = F.when(F.col("s_acctbal") > 0, "RELEVANT").otherwise("IRRELEVANT")
    return t.supplier.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("i94port"),
        F.col("s_name").alias("i94port_name"),
        F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("i94port_state"),
        relevant.alias("i94port_relevant"),
    )


def citizenship_lookup(t: Tables) -> DataFrame:
    continent = F.when(F.col("r_name") == "MIDDLE EAST", "INVALID").otherwise(
        F.col("r_name")
    )
    region = F.when(F.col("n_nationkey") < 12, "NORTH").otherwise("SOUTH")
    labelled = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return labelled.select(
        F.col("n_nationkey").cast("string").alias("i94cit"),
        F.col("n_name").alias("i94cit_label"),
        continent.alias("i94cit_continent"),
        region.alias("i94cit_global_region"),
    )


def cleaned(t: Tables, dated: str | None = None) -> DataFrame:
    labelled = arrivals.label_arrivals(
        raw_arrivals(t, dated),
        modes=arrivals.mode_labels(t.spark),
        ports=port_lookup(t),
        visas=arrivals.visa_labels(t.spark),
        citizenship=citizenship_lookup(t),
    )
    return arrivals.clean_arrivals(labelled)


def _cleaned_sql(dated: str) -> str:
    return f"""{ITEMS_SQL}, coded AS (
        SELECT
            CAST(l_shipdate AS DATE) AS arrdateclean,
            CASE left(o_orderpriority, 1) WHEN '1' THEN 'Air' WHEN '2' THEN 'Sea'
                WHEN '3' THEN 'Land' WHEN '4' THEN 'Not Reported' END
                AS i94mode_label,
            CASE o_orderstatus WHEN 'F' THEN 'Business' WHEN 'O' THEN 'Pleasure'
                ELSE 'Student' END AS i94visa_label,
            CASE c_mktsegment WHEN 'BUILDING' THEN 'M' WHEN 'MACHINERY' THEN 'F'
                ELSE 'O' END AS genderclean,
            c_acctbal / 80 AS age,
            s_name AS i94port_name,
            lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS i94port_state,
            n_name AS i94cit_label,
            r_name AS i94cit_continent,
            CASE WHEN n_nationkey < 12 THEN 'NORTH' ELSE 'SOUTH' END
                AS i94cit_global_region
        FROM items
        JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 0
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey AND r_name <> 'MIDDLE EAST'
        WHERE {dated}
    ), aged AS (
        SELECT *, CASE
            WHEN age >= 0 AND age < 18 THEN 'Below 18'
            WHEN age >= 18 AND age < 30 THEN '18 to 29'
            WHEN age >= 30 AND age < 40 THEN '30 to 39'
            WHEN age >= 40 AND age < 50 THEN '40 to 49'
            WHEN age >= 50 AND age < 60 THEN '50 to 59'
            WHEN age >= 60 AND age <= 120 THEN '60 and Above'
            ELSE 'Unknown' END AS agecategory
        FROM coded
    ), cleaned AS (
        SELECT *,
            lower(genderclean || left(i94cit_continent, 3) || left(agecategory, 2)
                  || left(i94cit_global_region, 1)) AS profile_id,
            CAST(month(arrdateclean) AS INTEGER) AS month,
            CAST(year(arrdateclean) AS INTEGER) AS year
        FROM aged
    )"""


WHOLE_SQL = _cleaned_sql("l_shipdate IS NOT NULL")
CLEANED_SQL = _cleaned_sql(f"l_shipdate IS NOT NULL AND {SHORT_ORDERS}")
CLEANED_COLUMNS = [
    "i94port_name",
    "i94port_state",
    "i94cit_label",
    "i94mode_label",
    "i94visa_label",
    "arrdateclean",
    "genderclean",
    "agecategory",
    "profile_id",
    "month",
    "year",
]


@query(f"WITH {WHOLE_SQL} SELECT {', '.join(CLEANED_COLUMNS)} FROM cleaned")
def arrivals_clean(t: Tables) -> DataFrame:
    """Labelled and cleaned arrivals."""
    return cleaned(t).select(*CLEANED_COLUMNS)


FACT_SQL = """
    SELECT i94port_state AS state_id, arrdateclean AS arrival_date, profile_id,
        count(*) AS all_travellers,
        nullif(count(*) FILTER (WHERE i94mode_label = 'Land'), 0) AS land_travellers,
        nullif(count(*) FILTER (WHERE i94mode_label = 'Sea'), 0) AS sea_travellers,
        nullif(count(*) FILTER (WHERE i94mode_label = 'Air'), 0) AS air_travellers,
        nullif(count(*) FILTER (WHERE i94visa_label = 'Business'), 0)
            AS business_travellers,
        nullif(count(*) FILTER (WHERE i94visa_label = 'Pleasure'), 0)
            AS pleasure_travellers,
        nullif(count(*) FILTER (WHERE i94visa_label = 'Student'), 0)
            AS student_travellers
    FROM cleaned GROUP BY ALL
"""


@query(f"WITH {WHOLE_SQL} {FACT_SQL}")
def arrivals_fact(t: Tables) -> DataFrame:
    """Travellers per state, day and profile."""
    return arrivals.arrivals_fact(cleaned(t))


@query(
    f"""
    WITH {CLEANED_SQL}
    SELECT DISTINCT profile_id, genderclean AS gender, agecategory AS age_category,
        i94cit_continent AS citizen_region,
        i94cit_global_region AS citizen_global_region
    FROM cleaned
    """
)
def traveller_profiles(t: Tables) -> DataFrame:
    """Distinct traveller profiles."""
    return arrivals.traveller_profiles(cleaned(t, SHORT_ORDERS))


@query(
    f"""
    WITH {CLEANED_SQL}
    SELECT DISTINCT arrdateclean AS "timestamp",
        CAST(day(arrdateclean) AS INTEGER) AS day, month, year,
        month || '-' || year AS month_year,
        CAST(dayofweek(arrdateclean) + 1 AS INTEGER) AS day_of_week
    FROM cleaned
    """
)
def arrival_calendar(t: Tables) -> DataFrame:
    """Distinct arrival dates with their parts."""
    return arrivals.calendar(cleaned(t, SHORT_ORDERS), "arrdateclean")


# --------------------------------------------------------------------- ports


def raw_ports(t: Tables) -> DataFrame:
    labelled = t.supplier.join(
        t.nation, F.col("s_nationkey") == F.col("n_nationkey")
    ).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    balance = F.col("s_acctbal")
    return labelled.select(
        F.when(balance < 0, "closed")
        .when(balance < 2500, "small_airport")
        .when(balance < 6000, "medium_airport")
        .otherwise("large_airport")
        .alias("type"),
        F.when(F.col("r_name") != "EUROPE", "US").otherwise("EU").alias("iso_country"),
        F.concat(F.lit("US-"), last_token(F.col("n_name"), "_")).alias("iso_region"),
        F.col("s_name").alias("municipality"),
    )


PORTS_SQL = """ports AS (
        SELECT split_part(n_name, '_', 2) AS state_id,
            CASE WHEN s_acctbal < 0 THEN 'closed'
                WHEN s_acctbal < 2500 THEN 'small_airport'
                WHEN s_acctbal < 6000 THEN 'medium_airport'
                ELSE 'large_airport' END AS port_type,
            s_name AS municipality
        FROM supplier
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        WHERE r_name <> 'EUROPE' AND length(split_part(n_name, '_', 2)) = 2
    )"""


@query(
    f"""
    WITH {PORTS_SQL}
    SELECT state_id, port_type, count(*) AS num_of_ports FROM ports GROUP BY 1, 2
    """
)
def ports_fact(t: Tables) -> DataFrame:
    """Ports per state and type."""
    return ports.ports_fact(ports.country_ports(raw_ports(t)))


@query(f"WITH {PORTS_SQL} SELECT DISTINCT state_id, municipality FROM ports")
def port_cities(t: Tables) -> DataFrame:
    """Distinct cities with a port."""
    return ports.port_cities(ports.country_ports(raw_ports(t)))


# -------------------------------------------------------------- demographics

RACES = {
    ("A", "F"): "Hispanic or Latino",
    ("A", "O"): "White",
    ("N", "F"): "Asian",
    ("N", "O"): "Black or African-American",
    ("R", "F"): "American Indian and Alaska Native",
}


def raw_demographics(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    flags = F.struct("l_returnflag", "l_linestatus")
    race = F.lit(None).cast("string")
    for (flag, status), name in RACES.items():
        pair = F.struct(F.lit(flag).alias("f"), F.lit(status).alias("s"))
        race = F.when(flags == pair, name).otherwise(race)
    code = F.lpad(F.col("c_nationkey").cast("string"), 2, "0")
    shaped = sold_items(t).select(
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("City"),
        F.concat(F.lit("State "), code).alias("State"),
        F.lit(None).cast("double").alias("Median Age"),
        F.floor(price / 3).cast("int").alias("Male Population"),
        F.floor(price / 2).cast("int").alias("Female Population"),
        F.floor(price).cast("int").alias("Total Population"),
        F.floor(price / 10).cast("int").alias("Number of Veterans"),
        F.floor(price / 5).cast("int").alias("Foreign-born"),
        ((F.dayofmonth("o_orderdate") - 1) / 8).alias("Average Household Size"),
        code.alias("State Code"),
        race.alias("Race"),
        F.col("l_quantity").cast("int").alias("Count"),
    )
    return shaped.select(*S.DEMOGRAPHICS.fieldNames())


def _race_sum(flag: str, status: str, name: str) -> str:
    return (
        "sum(CAST(l_quantity AS INTEGER)) FILTER (WHERE l_returnflag = "
        f"'{flag}' AND l_linestatus = '{status}') AS {name}"
    )


STATE_FACT_SQL = f"""cities AS (
        SELECT DISTINCT o_orderkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0')
                AS state_id, o_totalprice,
            (day(o_orderdate) - 1) / 8.0 AS hh_size
        FROM items
    ), people AS (
        SELECT state_id,
            CAST(sum(floor(o_totalprice)) AS BIGINT) AS total_pop,
            CAST(sum(floor(o_totalprice / 3)) AS BIGINT) AS male_pop,
            CAST(sum(floor(o_totalprice / 2)) AS BIGINT) AS female_pop,
            CAST(sum(floor(o_totalprice / 10)) AS BIGINT) AS veteran_pop,
            CAST(sum(floor(o_totalprice / 5)) AS BIGINT) AS foreign_pop,
            sum(floor(o_totalprice) / nullif(hh_size, 0)) AS households
        FROM cities GROUP BY state_id
    ), races AS (
        SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_id,
            {_race_sum("A", "F", "hispanic_pop")},
            {_race_sum("A", "O", "white_pop")},
            {_race_sum("N", "F", "asian_pop")},
            {_race_sum("N", "O", "black_pop")},
            {_race_sum("R", "F", "native_pop")}
        FROM items GROUP BY c_nationkey
    ), fact AS (
        SELECT state_id, total_pop, male_pop, female_pop, veteran_pop, foreign_pop,
            CAST(hispanic_pop AS BIGINT) AS hispanic_pop,
            CAST(white_pop AS BIGINT) AS white_pop,
            CAST(asian_pop AS BIGINT) AS asian_pop,
            CAST(black_pop AS BIGINT) AS black_pop,
            CAST(native_pop AS BIGINT) AS native_pop,
            round(total_pop / households, 4) AS avg_hh_size,
            round(households, 2) AS total_hh
        FROM people LEFT JOIN races USING (state_id)
    )"""


@query(f"WITH {ITEMS_SQL}, {STATE_FACT_SQL} SELECT * FROM fact")
def demographics_fact(t: Tables) -> DataFrame:
    """Population, households and people per race of each state."""
    fact = demographics.demographics_fact(raw_demographics(t))
    return fact.withColumns(
        {"avg_hh_size": F.round("avg_hh_size", 4), "total_hh": F.round("total_hh", 2)}
    )


@query(
    f"""
    WITH {ITEMS_SQL}
    SELECT DISTINCT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_id,
        'State ' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_name
    FROM items
    """
)
def demographic_states(t: Tables) -> DataFrame:
    """Distinct states."""
    return demographics.states(raw_demographics(t))


@query(
    f"""
    WITH {ITEMS_SQL}
    SELECT DISTINCT 'Order ' || o_orderkey AS "City",
        'State ' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS "State",
        lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_id
    FROM items
    """
)
def demographic_cities(t: Tables) -> DataFrame:
    """Distinct cities with their state."""
    return demographics.demographic_cities(raw_demographics(t))


# --------------------------------------------------------------- temperature


def raw_temperatures(t: Tables) -> DataFrame:
    country = F.when(F.col("o_orderpriority") != "5-LOW", "United States").otherwise(
        "Elsewhere"
    )
    return t.orders.select(
        F.to_date("o_orderdate").alias("dt"),
        # Orders in one state have no temperature.
        F.when(F.col("o_orderstatus") != "P", F.sqrt("o_totalprice")).alias("AverageTemperature"),
        F.col("o_custkey").cast("string").alias("City"),
        country.alias("Country"),
    )


def number_states(t: Tables) -> DataFrame:
    return pairs(t).select(
        F.col("number").cast("string").alias("City"),
        F.lpad(F.col("nation").cast("string"), 2, "0").alias("state_id"),
    )


def mapped_temperatures(t: Tables) -> DataFrame:
    """Observations with their state, stored: the fact reads them twice."""
    lookup = land(
        temperature.state_lookup(number_states(t)), staging_path(t.spark, "lookup")
    )
    mapped = temperature.map_states(temperature.observations(raw_temperatures(t)), lookup)
    columns = ["state_id", "City", "dt", "AverageTemperature"]
    return land(mapped.select(*columns), staging_path(t.spark, "mapped"))


TEMPERATURE_SQL = f"""
    WITH {PAIRS_SQL}, lookup AS (
        SELECT number, min(lpad(CAST(nation AS VARCHAR), 2, '0')) AS state_id
        FROM pairs GROUP BY number
    )
    SELECT state_id, CAST(year(o_orderdate) AS INTEGER) AS year,
        count(*) AS observation_count,
        count(DISTINCT o_custkey) AS num_of_cities,
        min(sqrt(o_totalprice)) AS min_temp, max(sqrt(o_totalprice)) AS max_temp,
        round(avg(sqrt(o_totalprice)), 4) AS avg_temp,
        quantile_disc(sqrt(o_totalprice), 0.5) AS median_temp
    FROM orders JOIN lookup ON o_custkey = number
    WHERE o_orderpriority <> '5-LOW' AND o_totalprice IS NOT NULL AND o_orderstatus <> 'P'
    GROUP BY state_id, year(o_orderdate)
"""


@query(TEMPERATURE_SQL)
def temperature_fact(t: Tables) -> DataFrame:
    """Yearly temperature figures of each state."""
    fact = temperature.temperature_fact(mapped_temperatures(t))
    return fact.withColumn("avg_temp", F.round("avg_temp", 4))


@query(TEMPERATURE_SQL)
def refreshed_temperatures(t: Tables) -> DataFrame:
    """The same from stored sketches of files, one of which is corrected after loading."""
    raw = raw_temperatures(t)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in S.TEMPERATURES if f.name not in raw.columns}
    named = raw.withColumns(missing).select(*S.TEMPERATURES.fieldNames())
    folders = [staging_path(t.spark, name) for name in ("early", "late")]
    paths = warehouse.Paths(staging_path(t.spark, "stage"), staging_path(t.spark, "out"))
    early = F.year("dt") < 1995
    for rows, folder in ((named.where(early), 0), (named, 1), (named.where(~early), 1)):
        # The late folder first holds all rows, then only its own.
        publish(rows, folders[folder], "csv")
        sketches = warehouse.prepare_temperatures(t.spark, [folders[folder]], paths)
    lookup = land(
        temperature.state_lookup(number_states(t)), staging_path(t.spark, "lookup")
    )
    fact = temperature.merged_temperature_fact(sketches, lookup)
    return fact.withColumn("avg_temp", F.round("avg_temp", 4))


# ------------------------------------------------------- published star schema


@query(
    f"""
    WITH {WHOLE_SQL}, travellers AS (
        SELECT i94port_state AS state_id, count(*) AS travellers
        FROM cleaned GROUP BY 1
    ), {STATE_FACT_SQL}
    SELECT t.state_id, t.travellers AS state_total_travellers,
        CAST(f.foreign_pop AS INTEGER) AS state_foreign_pop,
        round(CAST(t.travellers AS DOUBLE)
              / (SELECT CAST(sum(travellers) AS DOUBLE) FROM travellers) * 100, 4)
            AS state_traveller_perc,
        round(CAST(f.foreign_pop AS DOUBLE)
              / (SELECT CAST(sum(foreign_pop) AS DOUBLE) FROM fact) * 100, 3)
            AS foreign_pop_perc
    FROM travellers t JOIN fact f ON t.state_id = f.state_id
    ORDER BY state_foreign_pop DESC
    """
)
def published_traveller_share(t: Tables) -> DataFrame:
    """Two facts published under their contracts, checked, then queried in SQL."""
    paths = warehouse.Paths(staging_path(t.spark, "stage"), staging_path(t.spark, "out"))
    t = with_items(t)
    publish_table(arrivals.arrivals_fact(cleaned(t)), S.FACT_IMMIGRATION, paths.output)
    publish_table(
        demographics.demographics_fact(raw_demographics(t)),
        S.FACT_DEMOGRAPHICS,
        paths.output,
    )
    names = ["fact_immigration", "fact_demographics"]
    warehouse.check_tables(t.spark, paths, names)
    share = warehouse.traveller_share(t.spark, paths, names)
    # The SQL states an INTEGER; beyond its range, where the SQL fails, people keep the type
    # of the published table.
    most = share.agg(F.max("state_foreign_pop")).first()[0]
    if most is not None and most >= 1 << 31:
        return share
    return share.withColumn("state_foreign_pop", F.col("state_foreign_pop").cast("int"))


_MEASURES = {
    "fact_immigration": "all_travellers",
    "fact_ports": "num_of_ports",
    "fact_demographics": "total_pop",
    "fact_temperature": "observation_count",
}


@query(
    f"""
    WITH {CLEANED_SQL}, travellers AS ({FACT_SQL}), {PORTS_SQL}, {STATE_FACT_SQL},
    {PAIRS_SQL}, lookup AS (
        SELECT number, min(lpad(CAST(nation AS VARCHAR), 2, '0')) AS state_id
        FROM pairs GROUP BY number
    ), observed AS (
        SELECT state_id, year(o_orderdate) AS year, count(*) AS n
        FROM orders JOIN lookup ON o_custkey = number
        WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P'
        GROUP BY state_id, year(o_orderdate)
    )
    SELECT 'fact_immigration' AS table_name, count(*) AS row_count,
        CAST(sum(all_travellers) AS BIGINT) AS total FROM travellers
    UNION ALL SELECT 'fact_ports', count(DISTINCT (state_id, port_type)), count(*) FROM ports
    UNION ALL SELECT 'fact_demographics', count(*), CAST(sum(total_pop) AS BIGINT) FROM fact
    UNION ALL SELECT 'fact_temperature', count(*), CAST(sum(n) AS BIGINT) FROM observed
    UNION ALL SELECT 'dim_state', count(DISTINCT c_nationkey), NULL FROM items
    UNION ALL SELECT 'dim_datetime', count(DISTINCT arrdateclean), NULL FROM cleaned
    UNION ALL SELECT 'dim_traveller_profile', count(DISTINCT profile_id), NULL FROM cleaned
    """
)
def published_star_schema(t: Tables) -> DataFrame:
    """All seven tables published from inputs read once, checked, then counted and summed."""
    root = staging_path(t.spark, "out")
    t = with_items(t)
    staged = land(cleaned(t, SHORT_ORDERS), staging_path(t.spark, "cleaned"))
    located = land(ports.country_ports(raw_ports(t)), staging_path(t.spark, "ports"))
    cities = raw_demographics(t)
    fact = publish_table(arrivals.arrivals_fact(staged), S.FACT_IMMIGRATION, root)
    built = [
        (S.FACT_PORTS, ports.ports_fact(located)),
        (S.FACT_DEMOGRAPHICS, demographics.demographics_fact(cities)),
        (S.FACT_TEMPERATURE, temperature.temperature_fact(mapped_temperatures(t))),
        (S.DIM_STATE, demographics.states(cities)),
        (S.DIM_DATETIME, arrivals.calendar(fact, "arrival_date")),
        (S.DIM_TRAVELLER_PROFILE, arrivals.traveller_profiles(staged)),
    ]
    tables = {"fact_immigration": fact}
    for contract, df in built:
        tables[contract.name] = publish_table(df, contract, root)
    warehouse.check_references(t.spark, warehouse.Paths("", root))
    none = F.lit(None).cast("bigint")
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(
                F.lit(name).alias("table_name"),
                F.count("*").alias("row_count"),
                (F.sum(_MEASURES[name]).cast("bigint") if name in _MEASURES else none).alias("total"),
            )
            for name, df in tables.items()
        ],
    )


@query(f"WITH {CLEANED_SQL} {FACT_SQL}")
def refreshed_arrivals(t: Tables) -> DataFrame:
    """The fact after three batches, of which one was corrected and one written anew.

    The second batch is first loaded with all its arrivals 40 days late, so that its rows
    leave months when it is corrected; the third is a glob whose files get new names.
    """
    paths = warehouse.Paths(staging_path(t.spark, "stage"), staging_path(t.spark, "out"))
    raw = land(raw_arrivals(t, SHORT_ORDERS), staging_path(t.spark, "raw"))
    root = staging_path(t.spark, "batches")
    labels = {}
    for name, lookup in {
        "mode": arrivals.mode_labels(t.spark),
        "visa": arrivals.visa_labels(t.spark),
        "port": port_lookup(t),
        "citizenship": citizenship_lookup(t),
    }.items():
        labels[name] = publish(lookup, f"{root}/labels/{name}", "csv")

    def batch(number: int, days_late: int = 0) -> str:
        rows = raw.where(F.pmod(F.xxhash64("i94port"), F.lit(3)) == number)
        land(rows.withColumn("arrdate", F.col("arrdate") + days_late), f"{root}/b{number}")
        return f"{root}/b{number}" if number < 2 else f"{root}/b{number}/*.parquet"

    first = [batch(0), batch(1, days_late=40), batch(2)]
    warehouse.prepare_arrivals(t.spark, first, labels, paths)
    warehouse.build_arrivals(t.spark, paths)
    for number in (1, 2):
        again = [batch(number)]
        warehouse.prepare_arrivals(t.spark, again, labels, paths, refresh="batches")
        warehouse.build_arrivals(t.spark, paths, changes=True)
    warehouse.check_arrivals(t.spark, paths)
    fact = load_table(t.spark, S.FACT_IMMIGRATION, paths.output).drop("record_id")
    keys = S.FACT_IMMIGRATION.natural_key
    return fact.select(
        *keys, *[F.col(c).cast("bigint").alias(c) for c in fact.columns if c not in keys]
    )


@query(
    f"""
    WITH {CLEANED_SQL}, fact AS ({FACT_SQL})
    SELECT state_id, arrival_date, profile_id, all_travellers, true AS same_id,
        true AS unique_id FROM fact
    """
)
def lasting_ids(t: Tables) -> DataFrame:
    """Ids after a load of the early years, of all years, and of all again: none has changed."""
    root = staging_path(t.spark, "out")
    fact = land(
        arrivals.arrivals_fact(cleaned(t, SHORT_ORDERS)), staging_path(t.spark, "fact")
    )
    keys = list(S.FACT_IMMIGRATION.natural_key)
    first = publish_table(fact.where(F.year("arrival_date") < 1998), S.FACT_IMMIGRATION, root)
    early = first.select(*keys, F.col("record_id").alias("early_id"))
    for _ in range(2):
        last = publish_table(fact, S.FACT_IMMIGRATION, root)
    holders = last.groupBy("record_id").agg(F.count("*").alias("n"))
    return (
        last.join(early, keys, "left")
        .join(holders, "record_id")
        .select(
            *keys,
            F.col("all_travellers").cast("bigint").alias("all_travellers"),
            F.coalesce(F.col("record_id") == F.col("early_id"), F.lit(True)).alias("same_id"),
            (F.col("n") == 1).alias("unique_id"),
        )
    )

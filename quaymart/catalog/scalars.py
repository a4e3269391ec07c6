"""Scalar expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymart.catalog.registry import Tables, query
from quaymart.functions import (
    bucketize,
    composite_key,
    date_to_epoch_day,
    epoch_day_to_date,
    last_token,
    parse_date,
    parse_timestamp,
    sequence_id,
    stable_id,
    standardize,
    to_number,
)
from quaymart.plans.arrivals import (
    AGE_EDGES,
    AGE_LABELS,
    UNKNOWN_AGE,
    calendar,
)


def segment() -> Column:
    return standardize(F.col("c_mktsegment"), ["BUILDING", "MACHINERY"], "O")


def balance_bucket() -> Column:
    return bucketize(F.col("c_acctbal") / 80, AGE_EDGES, AGE_LABELS, UNKNOWN_AGE)


SEGMENT_SQL = (
    "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment "
    "ELSE 'O' END"
)
BUCKET_SQL = """CASE
        WHEN c_acctbal / 80 >= 0 AND c_acctbal / 80 < 18 THEN 'Below 18'
        WHEN c_acctbal / 80 >= 18 AND c_acctbal / 80 < 30 THEN '18 to 29'
        WHEN c_acctbal / 80 >= 30 AND c_acctbal / 80 < 40 THEN '30 to 39'
        WHEN c_acctbal / 80 >= 40 AND c_acctbal / 80 < 50 THEN '40 to 49'
        WHEN c_acctbal / 80 >= 50 AND c_acctbal / 80 < 60 THEN '50 to 59'
        WHEN c_acctbal / 80 >= 60 AND c_acctbal / 80 <= 120 THEN '60 and Above'
        ELSE 'Unknown' END"""


@query(
    """
    SELECT DISTINCT
        CAST(o_orderdate AS DATE) AS "timestamp",
        CAST(day(o_orderdate) AS INTEGER) AS day,
        CAST(month(o_orderdate) AS INTEGER) AS month,
        CAST(year(o_orderdate) AS INTEGER) AS year,
        month(o_orderdate) || '-' || year(o_orderdate) AS month_year,
        CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week
    FROM orders
    """
)
def epoch_day_dates(t: Tables) -> DataFrame:
    """Dates stored as day numbers, turned back and described."""
    days = t.orders.select(date_to_epoch_day(F.col("o_orderdate")).alias("day_number"))
    dates = days.select(epoch_day_to_date(F.col("day_number") + 0.25).alias("date"))
    return calendar(dates, "date")


@query(f"SELECT c_custkey, {SEGMENT_SQL} AS segment FROM customer")
def standardized_segment(t: Tables) -> DataFrame:
    """Two values kept, all others merged into one."""
    return t.customer.select("c_custkey", segment().alias("segment"))


@query(f"SELECT c_custkey, {BUCKET_SQL} AS bucket FROM customer")
def bucketed_balance(t: Tables) -> DataFrame:
    """Numbers put into named intervals, out-of-range values apart."""
    return t.customer.select("c_custkey", balance_bucket().alias("bucket"))


@query(
    f"""
    SELECT DISTINCT
        lower({SEGMENT_SQL} || substr(r_name, 1, 3)
              || substr({BUCKET_SQL}, 1, 2)) AS profile_id,
        {SEGMENT_SQL} AS segment, {BUCKET_SQL} AS bucket, r_name
    FROM customer
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    """
)
def profile_dim(t: Tables) -> DataFrame:
    """Distinct profiles with an id composed of their parts."""
    labelled = t.customer.join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    described = labelled.select(
        segment().alias("segment"), balance_bucket().alias("bucket"), "r_name"
    ).distinct()
    key = composite_key([F.col("segment"), (F.col("r_name"), 3), (F.col("bucket"), 2)])
    return described.select(key.alias("profile_id"), "segment", "bucket", "r_name")


@query(
    """
    SELECT split_part(n_name, '_', 2) AS token, count(*) AS num_suppliers
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    WHERE length(split_part(n_name, '_', 2)) = 2
    GROUP BY 1
    """
)
def region_token_ports(t: Tables) -> DataFrame:
    """Rows per last part of a code, where that part is two characters long."""
    token = last_token(F.col("n_name"), "_").alias("token")
    tokens = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), token)
    return (
        t.supplier.join(tokens.where(F.length("token") == 2), "s_nationkey")
        .groupBy("token")
        .agg(F.count("*").alias("num_suppliers"))
    )


@query(
    """
    SELECT event_id,
        CAST(ts AS DATE) AS event_date,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_second,
        value AS number,
        CAST(NULL AS DOUBLE) AS no_number
    FROM events
    """
)
def parsed_values(t: Tables) -> DataFrame:
    """Dates, timestamps and numbers read from text; other text becomes null."""
    text = t.events.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("date_text"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("second_text"),
        F.col("value").cast("string").alias("number_text"),
        "event_type",
    )
    return text.select(
        "event_id",
        parse_date(F.col("date_text")).alias("event_date"),
        parse_timestamp(F.col("second_text")).cast("string").alias("event_second"),
        to_number(F.col("number_text")).alias("number"),
        to_number(F.col("event_type")).alias("no_number"),
    )


@query(
    """
    SELECT count(*) AS num_rows, count(*) AS num_sequence_ids,
           count(DISTINCT o_custkey) AS num_stable_ids
    FROM orders
    """
)
def surrogate_ids(t: Tables) -> DataFrame:
    """Sequence ids differ on every row, stable ids on every key."""
    numbered = t.orders.select(
        sequence_id().alias("sequence_id"), stable_id(["o_custkey"]).alias("stable_id")
    )
    return numbered.agg(
        F.count("*").alias("num_rows"),
        F.count_distinct("sequence_id").alias("num_sequence_ids"),
        F.count_distinct("stable_id").alias("num_stable_ids"),
    )

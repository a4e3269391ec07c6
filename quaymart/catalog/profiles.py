"""Profiles."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.catalog.registry import Tables, query
from quaymart.operators import (
    attribute_variants,
    column_info,
    coverage_totals,
    distinct_profile,
    matched_rows,
    membership_flags,
    null_profile,
    numeric_summary,
    span,
    unstable_keys,
    value_counts,
    wide_profile,
    with_labels,
)


def _null_row(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count(*) AS row_count,
        count(*) FILTER (WHERE {column} IS NULL) AS null_count,
        round(CAST(count(*) FILTER (WHERE {column} IS NULL) AS DOUBLE)
              / count(*) * 100, 2) AS null_percent
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


@query(
    " UNION ALL ".join(map(_null_row, ["lang", "source", "quality", "toxic"])),
    "null_profile",
)
def null_counts(t: Tables) -> DataFrame:
    """Nulls of every column at once, where a left join leaves gaps."""
    labelled = with_labels(
        t.documents.select("doc_id", "lang", "source"), {"doc_id": t.labels}
    )
    return null_profile(labelled.drop("doc_id"))


@query(
    """
    WITH pairs AS (
        SELECT 'p_brand' AS column_name, p_brand AS value FROM part
        UNION ALL SELECT 'p_type', p_type FROM part
        UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR) FROM part
    ), counted AS (
        SELECT column_name, value, count(*) AS n FROM pairs GROUP BY 1, 2
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY value) AS place
        FROM counted
    )
    SELECT column_name, count(*) AS distinct_count,
        CAST(sum(n) AS BIGINT) AS row_count,
        string_agg(value || ':' || n, ',' ORDER BY value)
            FILTER (WHERE place <= 5) AS sample
    FROM ranked GROUP BY column_name
    """,
    "distinct_profile",
)
def distinct_counts(t: Tables) -> DataFrame:
    """Distinct values of several columns and the first few of them."""
    profile = distinct_profile(t.part, ["p_brand", "p_type", "p_size"])
    shown = F.transform(
        "sample_values",
        lambda s: F.concat(s["value"], F.lit(":"), s["row_count"].cast("string")),
    )
    return profile.select(
        "column_name",
        "distinct_count",
        "row_count",
        F.array_join(shown, ",").alias("sample"),
    )


@query(
    """
    SELECT 'event_type' AS column_name, event_type AS value, count(*) AS row_count
    FROM events GROUP BY event_type
    UNION ALL
    SELECT 'user_id', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY user_id
    ORDER BY row_count DESC, column_name, value
    """,
    "value_counts",
)
def value_frequencies(t: Tables) -> DataFrame:
    """Frequencies of all values of two columns, most frequent first."""
    return value_counts(t.events, ["event_type", "user_id"]).orderBy(
        F.desc("row_count"), "column_name", "value"
    )


@query(
    """
    SELECT p_type, count(p_name) AS total, count(sold) AS with_sales
    FROM part LEFT JOIN (
        SELECT DISTINCT l_partkey, 1 AS sold FROM lineitem WHERE l_discount > 0.09
    ) ON p_partkey = l_partkey
    GROUP BY p_type ORDER BY total DESC, p_type
    """
)
def type_counts(t: Tables) -> DataFrame:
    """Filled values of two columns per type."""
    sold = (
        t.lineitem.where("l_discount > 0.09")
        .select(F.col("l_partkey").alias("p_partkey"), F.lit(1).alias("sold"))
        .distinct()
    )
    return (
        with_labels(t.part, {"p_partkey": sold})
        .groupBy("p_type")
        .agg(F.count("p_name").alias("total"), F.count("sold").alias("with_sales"))
        .orderBy(F.desc("total"), "p_type")
    )


FLAGS_SQL = """
    SELECT c_custkey,
        CAST(c_custkey IN (SELECT o_custkey FROM orders) AS INTEGER) AS in_orders,
        CAST(c_custkey IN (SELECT s_suppkey FROM supplier) AS INTEGER) AS in_suppliers
    FROM customer GROUP BY c_custkey
"""


def key_flags(t: Tables) -> DataFrame:
    return membership_flags(
        t.customer,
        "c_custkey",
        {
            "in_orders": (t.orders, "o_custkey"),
            "in_suppliers": (t.supplier, "s_suppkey"),
        },
    )


@query(FLAGS_SQL)
def key_membership(t: Tables) -> DataFrame:
    """Distinct keys with a flag per other table that has them."""
    return key_flags(t)


@query(
    f"""
    SELECT count(*) AS total_keys, CAST(sum(in_orders) AS BIGINT) AS in_orders,
        CAST(sum(in_suppliers) AS BIGINT) AS in_suppliers
    FROM ({FLAGS_SQL})
    """
)
def coverage_report(t: Tables) -> DataFrame:
    """How many keys the other tables cover."""
    return coverage_totals(key_flags(t), ["in_orders", "in_suppliers"])


@query(
    """
    WITH brands AS (SELECT DISTINCT upper(lower(p_brand)) AS name FROM part),
    small AS (SELECT DISTINCT upper(p_brand) AS name FROM part WHERE p_size = 1)
    SELECT count(*) AS total_keys,
        count(*) FILTER (WHERE name IN (SELECT name FROM small)) AS in_small
    FROM brands
    """
)
def case_blind_coverage(t: Tables) -> DataFrame:
    """Coverage of names that two tables write in different case."""
    written = t.part.select(F.lower("p_brand").alias("brand"))
    small = t.part.where("p_size = 1").select(F.upper("p_brand").alias("name"))
    brands = written.select(F.upper("brand").alias("name"))
    return coverage_totals(
        membership_flags(brands, "name", {"in_small": (small, "name")}), ["in_small"]
    )


_SIGNED_SQL = "round(c_acctbal / 4000) * 0.5 + 0.0"


@query(
    f"""
    SELECT 'tier' AS column_name, count(DISTINCT tier) AS distinct_count,
        count(*) AS row_count, string_agg(DISTINCT CAST(tier AS VARCHAR), ',' ORDER BY
            CAST(tier AS VARCHAR)) AS sample
    FROM (SELECT {_SIGNED_SQL} AS tier FROM customer)
    """
)
def double_profile(t: Tables) -> DataFrame:
    """Distinct values of a column of doubles in which zeros of both signs occur."""
    tiers = t.customer.select((F.round(F.col("c_acctbal") / 4000) * 0.5).alias("tier"))
    values = F.transform("sample_values", lambda s: s["value"])
    return distinct_profile(tiers, ["tier"]).select(
        "column_name", "distinct_count", "row_count", F.array_join(values, ",").alias("sample")
    )


_PROFILED = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
                 "l_returnflag", "l_shipdate"],
}


def _wide_row(table: str, column: str) -> str:
    return f"""SELECT '{column}' AS column_name, CAST(sum(n) AS BIGINT) AS row_count,
        CASE WHEN count(*) <= 1000 OR count(*) * 100 >= sum(n) * 99
             THEN count(*) END AS distinct_count,
        coalesce(string_agg(value || ':' || n, ',' ORDER BY n DESC, value)
            FILTER (WHERE n * 100 >= (SELECT count(*) FROM {table})), '') AS frequent
    FROM (SELECT CAST({column} AS VARCHAR) AS value, count(*) AS n FROM {table} GROUP BY 1)"""


@query(
    " UNION ALL ".join(_wide_row(t, c) for t, columns in _PROFILED.items() for c in columns),
    "wide_profile",
)
def sketched_profile(t: Tables) -> DataFrame:
    """Exact counts where they matter, found by sketches: frequent values and possible keys."""
    both = wide_profile(t.orders, _PROFILED["orders"]).unionByName(
        wide_profile(t.lineitem, _PROFILED["lineitem"])
    )
    shown = F.transform(
        "frequent_values",
        lambda x: F.concat(x["value"], F.lit(":"), x["row_count"].cast("string")),
    )
    return both.select(
        "column_name", "row_count", "distinct_count", F.array_join(shown, ",").alias("frequent")
    )


@query(
    """
    SELECT count(*) AS common_rows FROM documents
    WHERE doc_id IN (SELECT doc_id FROM labels)
    """
)
def common_keys(t: Tables) -> DataFrame:
    """Rows whose key another table also has."""
    return matched_rows(t.documents.select("doc_id"), t.labels, "doc_id").agg(
        F.count("*").alias("common_rows")
    )


@query(
    """
    SELECT CAST(min(o_orderdate) AS DATE) AS min_date,
        CAST(max(o_orderdate) AS DATE) AS max_date,
        min(o_totalprice) AS min_price, max(o_totalprice) AS max_price
    FROM orders
    """,
    "span",
)
def time_span(t: Tables) -> DataFrame:
    """First and last value of several columns."""
    return span(
        t.orders.select(
            F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("price")
        ),
        ["date", "price"],
    )


def _summary_row(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count({column}) AS value_count,
        round(avg({column}), 4) AS mean, round(stddev_samp({column}), 4) AS stddev,
        CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max
    FROM lineitem"""


@query(" UNION ALL ".join(map(_summary_row, ["l_quantity", "l_tax", "l_suppkey"])))
def numeric_columns(t: Tables) -> DataFrame:
    """Summary of several numeric columns."""
    return numeric_summary(
        t.lineitem, ["l_quantity", "l_tax", "l_suppkey"]
    ).withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query(
    """
    SELECT 'o_orderkey' AS column_name, 'bigint' AS data_type,
        count(o_orderkey) AS non_null_count FROM orders
    UNION ALL SELECT 'o_custkey', 'bigint', count(o_custkey) FROM orders
    UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
    UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice) FROM orders
    UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
    UNION ALL SELECT 'o_orderpriority', 'string', count(o_orderpriority) FROM orders
    """
)
def column_types(t: Tables) -> DataFrame:
    """Type and filled values of every column."""
    return column_info(t.orders)


@query(
    """
    SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem
    ORDER BY 1, 2, 3 LIMIT 20
    """
)
def first_variants(t: Tables) -> DataFrame:
    """The first 20 combinations of a key and its attributes."""
    return attribute_variants(
        t.lineitem, ["l_returnflag"], ["l_linestatus", "l_linenumber"]
    ).limit(20)


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS num_variants FROM (
        SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    ) GROUP BY 1, 2 HAVING count(*) > 1
    """
)
def unstable_lines(t: Tables) -> DataFrame:
    """Keys whose attributes differ between rows."""
    return unstable_keys(
        t.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]
    )

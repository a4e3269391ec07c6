"""Lookups from several sources, de-duplication and mapping."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.catalog.registry import Tables, query
from quaymart.functions import last_token
from quaymart.operators import (
    ambiguous_keys,
    clean_lookup,
    keep_first,
    map_through,
    merge_lookups,
    one_value_per_key,
)
from quaymart.sources import land, staging_path

PAIRS_SQL = """pairs AS (
        SELECT CAST(split_part(c_name, '#', 2) AS BIGINT) AS number, c_nationkey AS nation
        FROM customer
        WHERE c_acctbal > 0 AND c_mktsegment NOT IN ('HOUSEHOLD', 'FURNITURE')
        UNION
        SELECT CAST(split_part(s_name, '#', 2) AS BIGINT) AS number, s_nationkey AS nation
        FROM supplier
    )"""


def numbered(df: DataFrame, name: str, nation: str) -> DataFrame:
    number = last_token(F.col(name), "#").cast("bigint")
    return df.select(number.alias("number"), F.col(nation).cast("string").alias("nation"))


def pairs(t: Tables) -> DataFrame:
    """Numbers of customers and suppliers with their nations; some have several.

    Customers of one segment have no nation, those of another the text of none.
    """
    segment = F.col("c_mktsegment")
    nation = F.when(segment == "FURNITURE", "None").when(
        segment != "HOUSEHOLD", F.col("c_nationkey").cast("string")
    )
    customers = t.customer.where("c_acctbal > 0").withColumn("nation", nation)
    merged = merge_lookups(
        [
            clean_lookup(numbered(customers, "c_name", "nation")),
            clean_lookup(numbered(t.supplier, "s_name", "s_nationkey")),
        ]
    )
    return merged.withColumn("nation", F.col("nation").cast("int"))


@query(f"WITH {PAIRS_SQL} SELECT * FROM pairs")
def merged_pairs(t: Tables) -> DataFrame:
    """Distinct union of two lookups."""
    return pairs(t)


@query(
    f"WITH {PAIRS_SQL} SELECT number, min(nation) AS nation FROM pairs GROUP BY number"
)
def merged_lookup(t: Tables) -> DataFrame:
    """The merged lookup with one value per key."""
    return one_value_per_key(pairs(t), "number", "nation")


@query(
    f"""
    WITH {PAIRS_SQL}
    SELECT number, count(DISTINCT nation) AS num_values FROM pairs
    GROUP BY number HAVING count(DISTINCT nation) > 1
    """
)
def ambiguous_numbers(t: Tables) -> DataFrame:
    """Keys the two lookups map to several values."""
    return ambiguous_keys(pairs(t), "number", "nation")


@query(
    f"""
    WITH {PAIRS_SQL}, lookup AS (
        SELECT number, min(nation) AS nation FROM pairs GROUP BY number
    )
    SELECT o_orderkey, o_custkey AS number, nation
    FROM orders JOIN lookup ON o_custkey = number
    """
)
def mapped_inner(t: Tables) -> DataFrame:
    """Orders mapped through the merged lookup; unmapped ones drop."""
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("number"))
    lookup = land(
        one_value_per_key(pairs(t), "number", "nation"), staging_path(t.spark, "lookup")
    )
    return map_through(orders, lookup, "number").select(
        "o_orderkey", "number", "nation"
    )


@query(
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS place
        FROM orders
    ) WHERE place = 1
    """
)
def first_order_per_customer(t: Tables) -> DataFrame:
    """One row per key, chosen by an explicit order."""
    return keep_first(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_totalprice"
    )


@query(
    """
    SELECT DISTINCT c_nationkey AS state_id, n_name AS state_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    """
)
def state_dim(t: Tables) -> DataFrame:
    """Distinct pairs of a wider table, under new names.

    The keys are made distinct before the join adds their names.
    """
    keys = t.customer.select(F.col("c_nationkey").alias("state_id")).distinct()
    names = t.nation.select(
        F.col("n_nationkey").alias("state_id"), F.col("n_name").alias("state_name")
    )
    return keys.join(names, "state_id")

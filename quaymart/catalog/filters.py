"""Filters, sorts and top rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.catalog.registry import Tables, query


@query(
    """
    SELECT c_custkey, c_name, c_acctbal FROM customer
    WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3 AND c_acctbal IS NOT NULL
    """
)
def equality_filter(t: Tables) -> DataFrame:
    """Two equalities and a not-null test, all pushed to the scan."""
    return t.customer.where(
        (F.col("c_mktsegment") == "BUILDING")
        & (F.col("c_nationkey") == 3)
        & F.col("c_acctbal").isNotNull()
    ).select("c_custkey", "c_name", "c_acctbal")


@query(
    """
    SELECT p_partkey, p_type, p_size FROM part
    WHERE p_type IN ('ECONOMY', 'PROMO', 'STANDARD')
    ORDER BY p_type, p_partkey
    """
)
def in_list_sorted(t: Tables) -> DataFrame:
    """Rows with one of a list of values, sorted by two columns."""
    return (
        t.part.where(F.col("p_type").isin("ECONOMY", "PROMO", "STANDARD"))
        .select("p_partkey", "p_type", "p_size")
        .orderBy("p_type", "p_partkey")
    )


@query(
    """
    SELECT l_suppkey, l_returnflag FROM lineitem
    WHERE l_linenumber = 1 AND l_returnflag <> 'None'
    GROUP BY l_suppkey, l_returnflag
    """
)
def numeric_filter_distinct(t: Tables) -> DataFrame:
    """Distinct pairs among the rows with one number and without a placeholder."""
    return (
        t.lineitem.where(
            (F.col("l_linenumber") == 1) & (F.col("l_returnflag") != "None")
        )
        .select("l_suppkey", "l_returnflag")
        .distinct()
    )


@query(
    """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
    """
)
def largest_orders(t: Tables) -> DataFrame:
    """The first rows of a sorted table: each task keeps its own top rows only."""
    return (
        t.orders.select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(20)
    )


@query(
    """
    SELECT DISTINCT event_type FROM events WHERE props IS NOT NULL
    """
)
def types_with_props(t: Tables) -> DataFrame:
    """Distinct values of one column where another is filled."""
    return t.events.where(F.col("props").isNotNull()).select("event_type").distinct()

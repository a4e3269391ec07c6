"""Roll-ups, pivots and shares."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.catalog.labels import nation_labels
from quaymart.catalog.registry import Tables, query
from quaymart.functions import ratio
from quaymart.operators import (
    counts_by_category,
    header_detail_rollup,
    join_measures,
    rollup,
    share_of_total,
    sums_by_category,
    with_labels,
)

PRIORITIES = {
    "1-URGENT": "urgent_orders",
    "2-HIGH": "high_orders",
    "3-MEDIUM": "medium_orders",
    "5-LOW": "low_orders",
}
FLAGS = {"A": "quantity_a", "N": "quantity_n", "R": "quantity_r"}


@query(
    """
    SELECT o_custkey, count(*) AS num_orders,
        count(DISTINCT o_orderstatus) AS num_states
    FROM orders GROUP BY o_custkey
    """
)
def grouped_counts(t: Tables) -> DataFrame:
    """Rows and distinct values per key."""
    return rollup(
        t.orders,
        ["o_custkey"],
        {"num_orders": F.count("*"), "num_states": F.count_distinct("o_orderstatus")},
    )


@query(
    """
    SELECT l_suppkey,
        round(sum(l_quantity), 2) AS l_quantity,
        round(sum(l_extendedprice), 2) AS l_extendedprice,
        round(sum(l_discount), 2) AS l_discount,
        round(sum(l_tax), 2) AS l_tax
    FROM lineitem GROUP BY l_suppkey
    """
)
def column_set_sums(t: Tables) -> DataFrame:
    """Sums of every fractional column of a table."""
    amounts = [name for name, kind in t.lineitem.dtypes if kind == "double"]
    return rollup(
        t.lineitem, ["l_suppkey"], {c: F.round(F.sum(c), 2) for c in amounts}
    )


@query(
    """
    SELECT o_custkey, o_orderstatus, count(*) AS all_orders,
        nullif(count(*) FILTER (WHERE o_orderpriority = '1-URGENT'), 0)
            AS urgent_orders,
        nullif(count(*) FILTER (WHERE o_orderpriority = '2-HIGH'), 0)
            AS high_orders,
        nullif(count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM'), 0)
            AS medium_orders,
        nullif(count(*) FILTER (WHERE o_orderpriority = '5-LOW'), 0)
            AS low_orders
    FROM orders GROUP BY o_custkey, o_orderstatus
    """
)
def pivot_counts(t: Tables) -> DataFrame:
    """Rows in total and per category; an absent category is null."""
    return rollup(
        t.orders,
        ["o_custkey", "o_orderstatus"],
        {
            "all_orders": F.count("*"),
            **counts_by_category("o_orderpriority", PRIORITIES),
        },
    )


@query(
    """
    SELECT o_custkey,
        count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent_orders,
        count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS high_orders,
        count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS medium_orders,
        count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS low_orders
    FROM orders GROUP BY o_custkey
    """
)
def zero_filled_pivot(t: Tables) -> DataFrame:
    """Rows per category; an absent category is zero."""
    return rollup(
        t.orders,
        ["o_custkey"],
        counts_by_category("o_orderpriority", PRIORITIES, fill_zero=True),
    )


@query(
    """
    SELECT l_suppkey,
        sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS quantity_a,
        sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS quantity_n,
        sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS quantity_r
    FROM lineitem GROUP BY l_suppkey
    """
)
def pivot_sums(t: Tables) -> DataFrame:
    """Sums per category."""
    return rollup(
        t.lineitem,
        ["l_suppkey"],
        sums_by_category("l_returnflag", "l_quantity", FLAGS),
    )


@query(
    """
    SELECT n.n_name, CAST(year(o.o_orderdate) AS INTEGER) AS year,
        count(o.o_totalprice) AS observation_count,
        count(DISTINCT o.o_custkey) AS num_of_customers,
        min(o.o_totalprice) AS min_price,
        max(o.o_totalprice) AS max_price,
        CAST((sum(CAST(round(o.o_totalprice * 100) AS HUGEINT)) * 20000
              + count(o.o_totalprice)) // (2 * count(o.o_totalprice)) AS DOUBLE)
            / 1000000 AS avg_price,
        quantile_disc(o.o_totalprice, 0.5) AS median_price
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    GROUP BY n.n_name, year(o.o_orderdate)
    """
)
def yearly_summary(t: Tables) -> DataFrame:
    """Count, distinct count, extremes, mean and median per group.

    Customers are made distinct per year before the join, so a customer with a
    third of all orders enters it once a year.
    """
    customers = with_labels(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"),
        {"c_nationkey": nation_labels(t)},
        "inner",
    )
    orders = t.orders.select(
        "o_custkey", "o_totalprice", F.year("o_orderdate").alias("year")
    )
    price = F.col("o_totalprice")
    keys = ["n_name", "year"]
    labelled = with_labels(orders, {"o_custkey": customers}, "inner")
    figures = rollup(
        labelled,
        keys,
        {
            "observation_count": F.count(price),
            "min_price": F.min(price),
            "max_price": F.max(price),
            "avg_price": F.avg(price.cast("decimal(18,2)")).cast("double"),
            "median_price": F.percentile_approx(price, 0.5, 10_000),
        },
    )
    seen = with_labels(
        orders.select("o_custkey", "year").distinct(), {"o_custkey": customers}, "inner"
    )
    customers_seen = rollup(seen, keys, {"num_of_customers": F.count("*")})
    return join_measures(figures, [customers_seen], keys)


@query(
    """
    WITH rows AS (
        SELECT * FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    ), headers AS (
        SELECT DISTINCT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM rows
    ), totals AS (
        SELECT o_orderpriority, sum(o_totalprice) AS total_price,
            sum(o_totalprice / nullif(o_custkey, 0)) AS total_units
        FROM headers GROUP BY o_orderpriority
    ), flags AS (
        SELECT o_orderpriority,
            sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS quantity_a,
            sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS quantity_n,
            sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS quantity_r
        FROM rows GROUP BY o_orderpriority
    )
    SELECT o_orderpriority, round(total_price, 2) AS total_price,
        round(total_units, 2) AS total_units, quantity_a, quantity_n, quantity_r,
        round(total_price / total_units, 4) AS price_per_unit
    FROM totals LEFT JOIN flags USING (o_orderpriority)
    """,
    "header_detail_rollup",
)
def header_and_detail(t: Tables) -> DataFrame:
    """Order figures counted once per order, item figures once per item."""
    repeated = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    rolled = header_detail_rollup(
        repeated,
        header=["o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"],
        keys=["o_orderpriority"],
        header_sums={
            "total_price": F.col("o_totalprice"),
            "total_units": ratio(F.col("o_totalprice"), F.col("o_custkey")),
        },
        detail_sums=sums_by_category("l_returnflag", "l_quantity", FLAGS),
    )
    per_unit = ratio(F.col("total_price"), F.col("total_units"))
    return rolled.withColumns(
        {
            "total_price": F.round("total_price", 2),
            "total_units": F.round("total_units", 2),
            "price_per_unit": F.round(per_unit, 4),
        }
    )


@query(
    """
    WITH c AS (
        SELECT c_nationkey, count(*) AS num_customers FROM customer GROUP BY 1
    ), s AS (
        SELECT s_nationkey, count(*) AS num_suppliers,
            round(sum(s_acctbal), 2) AS supplier_balance
        FROM supplier GROUP BY 1
    )
    SELECT n_nationkey, num_customers, num_suppliers, supplier_balance
    FROM nation
    LEFT JOIN c ON n_nationkey = c_nationkey
    LEFT JOIN s ON n_nationkey = s_nationkey
    """
)
def joined_measures(t: Tables) -> DataFrame:
    """Measures of two tables attached to the keys of a third."""
    customers = rollup(
        t.customer.withColumnRenamed("c_nationkey", "n_nationkey"),
        ["n_nationkey"],
        {"num_customers": F.count("*")},
    )
    suppliers = rollup(
        t.supplier.withColumnRenamed("s_nationkey", "n_nationkey"),
        ["n_nationkey"],
        {
            "num_suppliers": F.count("*"),
            "supplier_balance": F.round(F.sum("s_acctbal"), 2),
        },
    )
    return join_measures(
        t.nation.select("n_nationkey"), [customers, suppliers], ["n_nationkey"]
    )


SHARES_SQL = """
    WITH per_nation AS (
        SELECT n.n_name AS state_id, count(*) AS num_orders,
            sum(o.o_totalprice) AS total_price
        FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        GROUP BY n.n_name
    ), balances AS (
        SELECT n.n_name AS state_id, sum(s.s_acctbal) AS supplier_balance
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
        GROUP BY n.n_name
    ), order_shares AS (
        SELECT state_id, num_orders, total_price,
            sum(num_orders) OVER () AS all_orders,
            sum(total_price) OVER () AS all_prices
        FROM per_nation
    ), balance_shares AS (
        SELECT state_id, supplier_balance,
            sum(supplier_balance) OVER () AS all_balances
        FROM balances
    )
    SELECT o.state_id, o.num_orders, round(o.total_price, 2) AS total_price,
        round(b.supplier_balance, 2) AS supplier_balance,
        round(CAST(o.num_orders AS DOUBLE) / CAST(o.all_orders AS DOUBLE) * 100, 4)
            AS order_perc,
        round(o.total_price / o.all_prices * 100, 4) AS price_perc,
        round(b.supplier_balance / b.all_balances * 100, 3) AS balance_perc
    FROM order_shares o JOIN balance_shares b ON o.state_id = b.state_id
    WHERE o.num_orders IS NOT NULL AND b.supplier_balance IS NOT NULL
    ORDER BY supplier_balance DESC
"""


def orders_by_nation(t: Tables) -> DataFrame:
    """Number and value of orders per nation.

    Orders are summed up by customer before the join.  That is the join's own
    shuffle key, so it costs none, and a customer with a third of all orders
    reaches the join as one row.
    """
    per_customer = rollup(
        t.orders,
        ["o_custkey"],
        {"num_orders": F.count("*"), "total_price": F.sum("o_totalprice")},
    )
    labelled = with_labels(
        per_customer,
        {
            "o_custkey": t.customer.select(
                F.col("c_custkey").alias("o_custkey"), "c_nationkey"
            ),
            "c_nationkey": nation_labels(t),
        },
        "inner",
    )
    return rollup(
        labelled.withColumnRenamed("n_name", "state_id"),
        ["state_id"],
        {"num_orders": F.sum("num_orders"), "total_price": F.sum("total_price")},
    )


@query(SHARES_SQL, "share_of_total")
def share_of_total_report(t: Tables) -> DataFrame:
    """Measures of two facts side by side, each with its share of the total."""
    orders = share_of_total(
        orders_by_nation(t),
        {"order_perc": ("num_orders", 4), "price_perc": ("total_price", 4)},
    )
    balances = share_of_total(
        rollup(
            with_labels(
                t.supplier.withColumnRenamed("s_nationkey", "c_nationkey"),
                {"c_nationkey": nation_labels(t)},
                "inner",
            ).withColumnRenamed("n_name", "state_id"),
            ["state_id"],
            {"supplier_balance": F.sum("s_acctbal")},
        ),
        {"balance_perc": ("supplier_balance", 3)},
    )
    both = orders.join(balances, "state_id").where(
        F.col("num_orders").isNotNull() & F.col("supplier_balance").isNotNull()
    )
    return both.select(
        "state_id",
        "num_orders",
        F.round("total_price", 2).alias("total_price"),
        F.round("supplier_balance", 2).alias("supplier_balance"),
        "order_perc",
        "price_perc",
        "balance_perc",
    ).orderBy(F.desc("supplier_balance"))


@query(
    """
    SELECT s_nationkey, num_suppliers,
        round(CAST(num_suppliers AS DOUBLE)
              / (SELECT count(*) FROM supplier) * 100, 2) AS supplier_perc
    FROM (SELECT s_nationkey, count(*) AS num_suppliers FROM supplier GROUP BY 1)
    ORDER BY num_suppliers DESC, s_nationkey
    """
)
def share_of_total_sql(t: Tables) -> DataFrame:
    """The share of a total written as SQL text over the same tables."""
    return t.spark.sql(
        """
        WITH per_nation AS (
            SELECT s_nationkey, count(*) AS num_suppliers
            FROM {suppliers} GROUP BY 1
        )
        SELECT s_nationkey, num_suppliers,
            round(CAST(num_suppliers AS DOUBLE)
                  / (SELECT sum(num_suppliers) FROM per_nation) * 100, 2)
                AS supplier_perc
        FROM per_nation
        ORDER BY 2 DESC, 1
        """,
        suppliers=t.supplier,
    )

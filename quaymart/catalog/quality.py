"""Quality checks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.catalog.registry import Tables, query
from quaymart.operators import (
    Reference,
    counts_by_category,
    orphans,
    reconcile_totals,
    rollup,
    table_checks,
)

_KEPT = "o_orderstatus <> 'P'"
KEYS = {
    "customer": ["c_custkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "orders": ["o_orderkey"],
    "part": ["p_partkey"],
    "supplier": ["s_suppkey"],
}


def report(t: Tables) -> DataFrame:
    return table_checks({name: getattr(t, name) for name in KEYS}, KEYS)


def _count_row(table: str) -> str:
    return f"""SELECT '{table}' AS table_name, count(*) AS row_count,
        count(*) > 0 AS non_empty FROM {table}"""


@query(" UNION ALL ".join(map(_count_row, KEYS)))
def non_empty_check(t: Tables) -> DataFrame:
    """Tables with their rows; the unused distinct count is not computed."""
    return report(t).select("table_name", "row_count", "non_empty")


def _unique_row(table: str) -> str:
    key = " || '-' || ".join(KEYS[table])
    return f"""SELECT '{table}' AS table_name, count(*) AS row_count,
        count(DISTINCT {key}) AS distinct_keys,
        count(*) = count(DISTINCT {key}) AS unique_key
    FROM {table}"""


@query(" UNION ALL ".join(map(_unique_row, KEYS)))
def unique_check(t: Tables) -> DataFrame:
    """Tables with a unique key; one of them has repeated keys."""
    return report(t).select("table_name", "row_count", "distinct_keys", "unique_key")


def _total(name: str, kept: str) -> str:
    return f"""SELECT '{name}' AS check_name, fact_total, source_rows,
        fact_total = source_rows AS reconciled FROM (
        SELECT CAST(sum(all_orders) AS BIGINT) AS fact_total,
            (SELECT count(*) FROM orders) AS source_rows
        FROM (SELECT count(*) AS all_orders FROM orders WHERE {kept}
            GROUP BY o_custkey, o_orderdate))"""


@query(f"{_total('all', 'true')} UNION ALL {_total('finished', _KEPT)}", "reconcile_check")
def reconciled_totals(t: Tables) -> DataFrame:
    """Totals of two facts against the rows they should be built from; one misses some."""

    def fact(orders: DataFrame) -> DataFrame:
        return rollup(
            orders,
            ["o_custkey", "o_orderdate"],
            {
                "all_orders": F.count("*"),
                **counts_by_category("o_orderstatus", {"F": "finished_orders"}),
            },
        )

    return reconcile_totals(
        {
            "all": (fact(t.orders), "all_orders", t.orders),
            "finished": (fact(t.orders.where(_KEPT)), "all_orders", t.orders),
        }
    )


REFERENCES = (
    Reference("orders", "o_custkey", "customer", "c_custkey"),
    Reference("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    Reference("lineitem", "l_partkey", "part", "p_partkey"),
    Reference("customer", "c_nationkey", "nation", "n_nationkey"),
)
# Dimensions without some of their rows, so that there are orphans to find.
_LEFT = {"part": "p_size > 5", "nation": "n_regionkey <> 2"}


def _orphan_row(r: Reference) -> str:
    known = f"SELECT {r.key} FROM {r.dimension} WHERE {_LEFT.get(r.dimension, 'true')}"
    return f"""SELECT '{r.fact}' AS fact_name, '{r.column}' AS column_name,
        '{r.dimension}' AS dimension_name, count(*) AS row_count,
        count(*) FILTER (WHERE {r.column} NOT IN ({known})) AS orphan_rows,
        count(DISTINCT {r.column}) FILTER (WHERE {r.column} NOT IN ({known})) AS orphan_keys,
        count(*) FILTER (WHERE {r.column} NOT IN ({known})) = 0 AS complete
    FROM {r.fact}"""


@query(" UNION ALL ".join(map(_orphan_row, REFERENCES)))
def orphan_check(t: Tables) -> DataFrame:
    """Facts without their dimension row, for several facts and dimensions at once."""
    names = dict.fromkeys(n for r in REFERENCES for n in (r.fact, r.dimension))
    kept = {n: getattr(t, n).where(_LEFT.get(n, "true")) for n in names if n != "customer"}
    # Customers are a dimension and a fact here.
    return orphans(kept | {"customer": t.customer}, REFERENCES)

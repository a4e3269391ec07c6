"""Queries over rows that a cut or a narrow type would lose."""

import datetime as dt
import glob

import duckdb
import pytest

from quaymart.catalog import QUERIES, SQL
from quaymart.catalog.registry import SCHEMAS
from tests.test_catalog import comparable

DAY = dt.datetime(1995, 3, 9)


def order(key, customer, price):
    return (key, customer, "F", float(price), DAY, "1-URGENT")


def item(order_key, supplier, line):
    return (order_key, 1, supplier, line, 5.0, 10.0, 0.0, 0.0, "A", "F", DAY)


ROWS = {
    "region": [(0, "AFRICA"), (1, "ASIA"), (2, "MIDDLE EAST")],
    "nation": [(0, "NATION_10", 0), (5, "NATION_15", 1), (7, "NATION_17", 1), (8, "NATION_18", 2)],
    "customer": [
        (n, f"Customer#{n}", nation, 2000.0, "BUILDING") for n, nation in enumerate((0, 5, 7, 8))
    ],
    # No balance of the third nation is known, and one port is closed.
    "supplier": [
        (1, "Supplier#1", 0, 300.0), (2, "Supplier#2", 5, 100.0), (3, "Supplier#3", 7, None),
        (4, "Supplier#4", 5, -50.0),
    ],
    "orders": [order(1, 0, 1000), order(2, 1, 500), order(3, 2, 250), order(4, 3, 125)],
    "lineitem": [item(1, 1, 1), item(1, 1, 7), item(2, 2, 7), item(2, 2, None), item(3, 2, 1),
                 item(3, 4, 1), item(4, 1, 1)],
    "events": [
        (1, DAY, 1, "error", 0.5, "{}"), (2, DAY, 1, "view", 0.5, "{}"),
        (3, DAY, 1, "click", 0.5, None), (4, DAY, 1, None, 0.5, "{}"),
    ],
}


@pytest.fixture
def written(spark, tmp_path):
    """Writes the rows above, some tables replaced; gives the folder."""

    def write(**changed):
        for name, found in (ROWS | changed).items():
            df = spark.createDataFrame(found, SCHEMAS[name])
            df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def in_duckdb(folder, sql):
    duck = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = path.rsplit("/", 1)[1].removesuffix(".parquet")
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/*.parquet'")
    cursor = duck.execute(sql)
    return comparable([c[0] for c in cursor.description], cursor.fetchall())


def result(spark, folder, name):
    """The rows of a query, which are those of its SQL."""
    df = QUERIES[name](spark, folder)
    found = df.collect()
    assert comparable(df.columns, found) == in_duckdb(folder, SQL[name])
    return found


# People of six cities of one state, beyond the range of an INTEGER: 12,000,000,000 in all.
CROWDED = [order(n, 0, 2_000_000_000) for n in range(1, 7)]
CROWDED_ITEMS = [item(n, 1, 1) for n in range(1, 7)]


def test_star_schema_of_states_beyond_an_integer(spark, written):
    folder = written(orders=CROWDED, lineitem=CROWDED_ITEMS)
    totals = {r.table_name: r.total for r in result(spark, folder, "published_star_schema")}
    assert totals["fact_demographics"] == 12_000_000_000


def test_traveller_share_of_states_beyond_an_integer(spark, written):
    folder = written(orders=CROWDED[:4], lineitem=CROWDED_ITEMS[:4])
    (row,) = result(spark, folder, "published_traveller_share")
    assert (row.state_total_travellers, row.state_foreign_pop) == (4, 1_600_000_000)
    assert dict(QUERIES["published_traveller_share"](spark, folder).dtypes)["state_foreign_pop"] == "int"


def test_traveller_share_where_its_sql_has_no_result(spark, written):
    folder = written(orders=CROWDED, lineitem=CROWDED_ITEMS)
    (row,) = QUERIES["published_traveller_share"](spark, folder).collect()
    assert (row.state_total_travellers, row.state_foreign_pop) == (6, 2_400_000_000)
    assert (row.state_traveller_perc, row.foreign_pop_perc) == (100.0, 100.0)


def test_types_of_all_events_with_properties(spark, written):
    folder = written()
    found = {r.event_type for r in result(spark, folder, "types_with_props")}
    assert found == {"error", "view", None}
    every = SQL["types_with_props"].replace("props IS NOT NULL", "true")
    assert len(in_duckdb(folder, every)) == 4  # the filter matters


def test_arrivals_of_all_lines(spark, written):
    folder = written()
    found = result(spark, folder, "arrivals_clean")
    assert len(found) == 5  # all but a closed port's and those of one region
    for part in (" AND s_acctbal > 0", " AND r_name <> 'MIDDLE EAST'"):  # the filters matter
        assert len(in_duckdb(folder, SQL["arrivals_clean"].replace(part, ""))) == 6


def test_fact_of_arrivals_of_all_lines(spark, written):
    found = result(spark, written(), "arrivals_fact")
    assert sum(r.all_travellers for r in found) == 5


def test_traveller_share_of_all_lines(spark, written):
    found = result(spark, written(), "published_traveller_share")
    assert {r.state_id: r.state_total_travellers for r in found} == {"00": 2, "05": 3}


def test_shares_of_all_nations(spark, written):
    folder = written()
    found = {r.state_id: (r.supplier_balance, r.balance_perc) for r in result(spark, folder, "share_of_total")}
    assert found == {"NATION_10": (300.0, 85.714), "NATION_15": (50.0, 14.286)}
    every = SQL["share_of_total"].replace("b.supplier_balance IS NOT NULL", "true")
    assert len(in_duckdb(folder, every)) == 3  # the filter matters

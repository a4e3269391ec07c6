"""Every query against its SQL in DuckDB, on the smallest provided tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from quaymart.catalog import QUERIES, SQL
from tests.helpers import plan

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(
    not os.path.isdir(FOLDER), reason="the provided tables are not here"
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def comparable(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(shown(row[i]) for i in order) for row in found)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= entry_points.queries().items()
    assert SQL.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    text = plan(df)
    for bad in ("CartesianProduct", "NestedLoopJoin", "Python", "RoundRobin"):
        assert bad not in text
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    expected = comparable(columns, cursor.fetchall())
    assert comparable(df.columns, df.collect()) == expected


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


# Parts of queries that drop or change rows, and what the SQL would be without them.
MATTERS = [
    ("merged_pairs", " AND c_mktsegment NOT IN ('HOUSEHOLD', 'FURNITURE')", ""),
    ("lasting_ids", " AND l_linenumber <> 7", ""),
    ("temperature_fact", " AND o_orderstatus <> 'P'", ""),
    ("case_blind_coverage", "SELECT DISTINCT upper(p_brand)", "SELECT DISTINCT lower(p_brand)"),
    ("reconcile_check", "WHERE o_orderstatus <> 'P'", ""),
    ("orphan_check", "WHERE p_size > 5", ""),
    ("unreadable_rows", "s_acctbal < 2000", "s_acctbal < -2000"),
    ("double_profile", " + 0.0", ""),
]


@pytest.mark.parametrize(("name", "part", "without"), MATTERS)
def test_the_part_matters(duck, name, part, without):
    def result(sql):
        cursor = duck.execute(sql)
        return sorted(repr(r) for r in cursor.fetchall())

    assert part in SQL[name]
    assert result(SQL[name]) != result(SQL[name].replace(part, without))

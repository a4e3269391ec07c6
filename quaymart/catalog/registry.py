"""Collects the queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Column types of the tables, stated so that no job has to read file footers for
# them before a query starts.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, "
    "p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
    "o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, "
    "l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
    "l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, "
    "n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The Parquet tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self._folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        path = f"{self._folder}/{name}.parquet"
        table = self.spark.read.schema(SCHEMAS[name]).parquet(path)
        setattr(self, name, table)
        return table


def query(sql: str | None = None, name: str | None = None):
    """Register a function of :class:`Tables` under a name, else its own."""

    def register(function: Callable[[Tables], DataFrame]):
        key = name or function.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Tables(spark, folder))

        run.__name__ = key
        run.__doc__ = function.__doc__
        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql
        return function

    return register

"""Round trips through files.

Each writes below the shared folder of the session and reads the result back.
"""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from quaymart.catalog.registry import Tables, query
from quaymart.schemas import Table
from quaymart.sources import (
    land,
    monthly_paths,
    publish,
    publish_table,
    read_batches,
    read_csv,
    read_csv_checked,
    read_footers,
    read_lookup,
    read_parquet,
    schema_report,
    staging_path,
)

CONFORMED = Table(
    "conformed_orders",
    StructType(
        [
            StructField("record_id", LongType(), nullable=False),
            StructField("order_id", LongType(), nullable=False),
            StructField("order_date", DateType(), nullable=False),
            StructField("customer_id", IntegerType(), nullable=False),
            StructField("price", DecimalType(18, 4)),
        ]
    ),
    key="record_id",
    natural_key=("order_id",),
    partitions={"year_": "year(order_date)"},
)


@query(
    """
    SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
        CAST(o_custkey AS INTEGER) AS customer_id,
        CAST(CAST(o_totalprice AS DECIMAL(18, 4)) AS DOUBLE) AS price
    FROM orders
    """
)
def conformed_orders(t: Tables) -> DataFrame:
    """Orders cast to a contract, written by year with ids and read back."""
    renamed = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("price"),
    )
    root = staging_path(t.spark, "tables")
    table = publish_table(renamed, CONFORMED, root).drop("record_id")
    return table.withColumn("price", F.col("price").cast("double"))


@query(
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice
    FROM orders
    """
)
def repeated_csv_load(t: Tables) -> DataFrame:
    """A typed CSV table by month, loaded twice: the second run changes nothing."""
    path = staging_path(t.spark, "orders_csv")
    dated = t.orders.select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_date"), "o_totalprice"
    )
    by_month = {"month_": "month(order_date)", "year_": "year(order_date)"}
    for _ in range(2):
        publish(dated, path, "csv", by_month, refresh="partitions")
    return read_csv(
        t.spark, path, schema=dated.schema, date_format="yyyy-MM-dd"
    ).select(*dated.columns)


@query(
    """
    SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, c_custkey, c_acctbal
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    """
)
def csv_sources(t: Tables) -> DataFrame:
    """A text lookup and a ``;`` separated typed table, both read from CSV."""
    lookup_path = publish(t.nation, staging_path(t.spark, "nation"), "csv")
    typed_path = staging_path(t.spark, "customer")
    t.customer.write.option("header", True).option("sep", ";").csv(typed_path)
    lookup = read_lookup(t.spark, lookup_path, t.nation.columns)
    customers = read_csv(t.spark, typed_path, schema=t.customer.schema, sep=";")
    return customers.join(
        lookup.withColumn("c_nationkey", F.col("n_nationkey").try_cast("int")),
        "c_nationkey",
    ).select("n_nationkey", "n_name", "c_custkey", "c_acctbal")


@query(
    """
    SELECT p_partkey, p_brand, p_size, p_retailprice FROM part
    """
)
def inferred_csv(t: Tables) -> DataFrame:
    """A CSV table whose types are found from the data."""
    path = publish(t.part, staging_path(t.spark, "part"), "csv")
    found = read_csv(t.spark, path, infer=True)
    return found.select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"),
        "p_brand",
        "p_size",
        "p_retailprice",
    )


@query(
    """
    SELECT o_orderkey, o_totalprice, CAST(month(o_orderdate) AS INTEGER) AS month,
        CAST(year(o_orderdate) AS INTEGER) AS year
    FROM orders
    WHERE o_orderdate >= '1996-11-01' AND o_orderdate < '1997-03-01'
    """,
    "multi_path_batch",
)
def monthly_batches(t: Tables) -> DataFrame:
    """Orders stored by month; a range of months is read as one batch."""
    path = staging_path(t.spark, "orders_by_month")
    publish(
        t.orders.select("o_orderkey", "o_orderdate", "o_totalprice"),
        path,
        partition_by={"year": "year(o_orderdate)", "month": "month(o_orderdate)"},
    )
    months = monthly_paths("%Y-%m", date(1996, 11, 1), date(1997, 2, 1))
    folders = [
        f"{path}/year={int(m[:4])}/month={int(m[5:])}" for m in months
    ]
    return read_batches(
        t.spark,
        folders,
        ["o_orderkey", "o_totalprice", "month", "year"],
        basePath=path,
    )


@query(
    """
    SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS event_type, value
    FROM events WHERE event_type = 'click'
    UNION ALL
    SELECT event_id, user_id, event_type, CAST(NULL AS DOUBLE)
    FROM events WHERE event_type <> 'click'
    """
)
def drifting_batches(t: Tables) -> DataFrame:
    """Batches whose files have different columns, matched by name."""
    clicks = F.col("event_type") == "click"
    first, second = (staging_path(t.spark, name) for name in ("first", "second"))
    land(t.events.where(clicks).select("event_id", "user_id", "value"), first)
    land(t.events.where(~clicks).select("event_type", "event_id", "user_id"), second)
    return read_batches(
        t.spark,
        [first, second],
        ["event_id", "user_id", "event_type", "value"],
        schemas_differ=True,
    )


def drifted(t: Tables) -> list[str]:
    """Line items by month of the year in three folders whose columns and types differ."""
    month = F.month("l_shipdate")
    early = t.lineitem.where(month <= 4).select(
        "l_orderkey",
        F.col("l_linenumber").cast("short").alias("l_linenumber"),
        F.col("l_quantity").cast("float").alias("l_quantity"),
        F.to_date("l_shipdate").alias("l_shipdate"),
    )
    middle = t.lineitem.where((month > 4) & (month <= 8)).select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_quantity"
    )
    late = t.lineitem.where(month > 8).select(
        F.col("l_shipdate").alias("L_SHIPDATE"),
        F.col("l_linenumber").cast("long").alias("l_linenumber"),
        "l_orderkey",
        F.col("l_quantity").cast("decimal(12,2)").alias("l_tax"),
    )
    paths = [staging_path(t.spark, name) for name in ("early", "middle", "late")]
    for part, path in zip((early, middle, late), paths, strict=True):
        land(part, path)
    return paths


@query(
    """
    WITH parts AS (
        SELECT CASE WHEN month(l_shipdate) <= 4 THEN 1
            WHEN month(l_shipdate) <= 8 THEN 2 ELSE 3 END AS part
        FROM lineitem
    ), columns (column_name, data_types, first, second, third) AS (
        VALUES ('l_orderkey', 'long', 1, 2, 3),
            ('l_linenumber', 'integer,long,short', 1, 2, 3),
            ('l_quantity', 'double,float', 1, 2, 0),
            ('l_shipdate', 'date,timestamp_ntz', 1, 0, 3),
            ('l_returnflag', 'string', 0, 2, 0),
            ('l_tax', 'decimal(12,2)', 0, 0, 3)
    )
    SELECT column_name, data_types,
        CAST(count(*) FILTER (WHERE part IN (first, second, third)) AS BIGINT) AS row_count,
        CAST(count(*) FILTER (WHERE part NOT IN (first, second, third)) AS BIGINT)
            AS missing_rows
    FROM parts, columns GROUP BY column_name, data_types
    """
)
def schema_differences(t: Tables) -> DataFrame:
    """Columns and types of files that differ, with the rows that have and lack them."""
    footers = land(read_footers(t.spark, drifted(t)), staging_path(t.spark, "footers"))
    return schema_report(footers).drop("file_count")


@query(
    """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        CASE WHEN month(l_shipdate) <= 8 THEN l_quantity END AS l_quantity,
        CASE WHEN month(l_shipdate) <= 4 THEN date_trunc('day', l_shipdate)
            WHEN month(l_shipdate) > 8 THEN l_shipdate END AS l_shipdate,
        CASE WHEN month(l_shipdate) BETWEEN 5 AND 8 THEN l_returnflag END AS l_returnflag,
        CASE WHEN month(l_shipdate) > 8 THEN l_quantity END AS l_tax
    FROM lineitem
    """
)
def widened_batches(t: Tables) -> DataFrame:
    """Files whose columns and types differ, read as one table in one scan."""
    paths = drifted(t)
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag", "l_tax"]
    table = read_batches(t.spark, paths, columns, schemas_differ=True)
    return table.withColumns(
        {"l_tax": F.col("l_tax").cast("double"), "l_shipdate": F.col("l_shipdate").cast("timestamp_ntz")}
    )


@query(
    """
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
    """
)
def landed_table(t: Tables) -> DataFrame:
    """A text source parsed once, then read as Parquet."""
    path = publish(t.supplier, staging_path(t.spark, "supplier_csv"), "csv")
    parsed = read_csv(t.spark, path, schema=t.supplier.schema)
    parquet = staging_path(t.spark, "supplier")
    land(parsed, parquet)
    return read_parquet(t.spark, parquet, t.supplier.columns)


@query(
    """
    SELECT CASE WHEN s_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS folder,
        count(*) FILTER (WHERE s_acctbal >= 2000) AS good_rows,
        count(*) FILTER (WHERE s_acctbal < 2000) AS bad_rows,
        round(coalesce(sum(s_acctbal) FILTER (WHERE s_acctbal >= 2000), 0), 2) AS balance
    FROM supplier GROUP BY 1
    """
)
def unreadable_rows(t: Tables) -> DataFrame:
    """Readable and unreadable rows of text files by folder, from one parse.

    Low balances are written as text, and the lowest without their last field.
    """
    root = staging_path(t.spark, "suppliers")
    balance = F.col("s_acctbal")
    fields = ["s_suppkey", "s_name", "s_nationkey"]
    full = F.concat_ws(";", *fields, F.when(balance < 2000, "low").otherwise(balance.cast("string")))
    line = F.when(balance < 0, F.concat_ws(";", *fields)).otherwise(full)
    header = t.spark.range(1).select(F.lit(";".join(t.supplier.columns)).alias("line"))
    for folder, rest in (("even", 0), ("odd", 1)):
        lines = t.supplier.where(F.col("s_nationkey") % 2 == rest)
        rows = lines.select(F.lit(1).alias("place"), line.alias("line"))
        named = header.select(F.lit(0).alias("place"), "line").unionByName(rows)
        # The header comes first; one small file each.
        named.repartition(1).sortWithinPartitions("place").select("line").write.text(f"{root}/{folder}")
    good, bad = read_csv_checked(
        t.spark,
        [f"{root}/even", f"{root}/odd"],
        t.supplier.schema,
        staging_path(t.spark, "parsed"),
        ";",
    )
    parity = F.when(F.col("s_nationkey") % 2 == 0, "even").otherwise("odd")
    folder = F.element_at(F.split("file", "/"), -2)
    amounts = good.select(
        parity.alias("folder"), F.lit(1).alias("good"), F.lit(0).alias("bad"), "s_acctbal"
    ).unionByName(
        bad.select(
            folder.alias("folder"), F.lit(0).alias("good"), F.lit(1).alias("bad"), F.lit(0.0).alias("s_acctbal")
        )
    )
    return amounts.groupBy("folder").agg(
        F.sum("good").alias("good_rows"),
        F.sum("bad").alias("bad_rows"),
        F.round(F.sum("s_acctbal"), 2).alias("balance"),
    )

"""Label joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.catalog.registry import Tables, query
from quaymart.operators import hot_values, join_hot, prepare_lookups, with_labels


def nation_labels(t: Tables) -> DataFrame:
    return t.nation.withColumnRenamed("n_nationkey", "c_nationkey")


def customer_labels(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey"
    )


@query(
    """
    SELECT o.o_orderkey, c.c_mktsegment, n.n_name, r.r_name
    FROM orders o
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE r.r_name <> 'MIDDLE EAST'
    """
)
def labelled_orders(t: Tables) -> DataFrame:
    """Orders labelled by three chained lookups; an unwanted or missing region drops."""
    labelled = with_labels(
        t.orders.select("o_orderkey", "o_custkey"),
        {
            "o_custkey": customer_labels(t),
            "c_nationkey": nation_labels(t),
            "n_regionkey": t.region.withColumnRenamed("r_regionkey", "n_regionkey"),
        },
    )
    return labelled.where(F.col("r_name") != "MIDDLE EAST").select(
        "o_orderkey", "c_mktsegment", "n_name", "r_name"
    )


@query(
    """
    SELECT c.c_custkey, c.c_acctbal, n.n_name, n.n_regionkey
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    """
)
def checked_labels(t: Tables) -> DataFrame:
    """Customers labelled from a lookup with text keys, checked before the join."""
    text_keys = nation_labels(t).withColumn(
        "c_nationkey", F.col("c_nationkey").cast("string")
    )
    customers = t.customer.select("c_custkey", "c_acctbal", "c_nationkey")
    key_type = customers.schema["c_nationkey"].dataType
    lookups = prepare_lookups({"c_nationkey": text_keys}, {"c_nationkey": key_type})
    return with_labels(customers, lookups).drop("c_nationkey")


@query(
    """
    SELECT d.doc_id, d.lang, l.quality, l.toxic
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL
      AND d.lang IS NOT NULL
    """
)
def fully_labelled_documents(t: Tables) -> DataFrame:
    """Documents without a null in any column after the label join."""
    return with_labels(
        t.documents.select("doc_id", "lang"), {"doc_id": t.labels}
    ).na.drop("any")


@query(
    """
    SELECT d.lang, count(*) AS num_documents,
           count(*) FILTER (WHERE l.quality IS NULL) AS num_unlabelled
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    GROUP BY d.lang
    """
)
def unlabelled_documents(t: Tables) -> DataFrame:
    """Documents per language and how many have no label."""
    labelled = with_labels(t.documents.select("doc_id", "lang"), {"doc_id": t.labels})
    return labelled.groupBy("lang").agg(
        F.count("*").alias("num_documents"),
        F.count_if(F.col("quality").isNull()).alias("num_unlabelled"),
    )


@query(
    """
    SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, p.p_brand, p.p_size
    FROM lineitem l LEFT JOIN part p
        ON p.p_partkey = CASE WHEN l.l_linenumber <= 2 THEN 1 ELSE l.l_partkey * 2 END
    """
)
def hot_labels(t: Tables) -> DataFrame:
    """Line items labelled by part, where one part has a large share of all rows."""
    part = F.when(F.col("l_linenumber") <= 2, F.lit(1).cast("bigint")).otherwise(F.col("l_partkey") * 2)
    items = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", part.alias("p_partkey")
    )
    parts = t.part.select("p_partkey", "p_brand", "p_size")
    hot = hot_values(items, ["p_partkey"])["p_partkey"]
    return join_hot(items, parts, "p_partkey", hot).drop("p_partkey")

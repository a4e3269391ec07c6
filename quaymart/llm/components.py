"""Connected components of a graph given as edges between whole numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest of it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), "m")
    return moved.unionByName(least.select("u", "m")).withColumnRenamed("m", "v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """The smallest node reachable from each node that has an edge: ``node, root``.

    ``edges`` has columns ``u`` and ``v``; direction, repeats and loops don't matter.
    Stars are merged in rounds until they stand still, each round written to the
    shared folder.  No neighbour list is ever built: a node's neighbours only meet
    as partial minima, and the joins are plain equi-joins.
    """
    pair = (F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stored(edges.where("u != v").select(*pair).distinct(), "edges")
    seen = None
    while True:
        state = now.agg(
            F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.crc32(F.concat_ws(",", "u", "v")))
        ).first()
        if state == seen:
            break
        seen = state
        now = stored(_small_star(_large_star(now)), "stars")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )

"""Queries over the provided tables, one an operator, and SQL where it can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymart.llm import (
    bpe,
    decontaminate,
    licenses,
    line_dedup,
    mixing,
    pii,
    quality,
    ranked_search,
    simhash,
    spelling,
    sql,
    syncmers,
    url_filter,
    warc,
)
from quaymart.llm.common import read


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Each document without the lines that five or more sources share."""
    return line_dedup.dedup_lines(read(spark, folder, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "text"
    )


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document that the mix takes."""
    return mixing.copies(read(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and labels of each document."""
    return licenses.scan(read(spark, folder, "documents"))


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in each document."""
    return pii.scan(read(spark, folder, "documents"))


def op5_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of each document and its edited text."""
    return syncmers.fingerprints(read(spark, folder, "documents"))


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of each document and what they decode to, as hashes."""
    return bpe.round_trip(read(spark, folder, "documents")).drop("ids")


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate group of each document."""
    return simhash.clusters(read(spark, folder, "documents"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on each page's url."""
    return url_filter.verdicts(read(spark, folder, "pages"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written to archives and read back."""
    return warc.archived(read(spark, folder, "pages"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Features and verdict of each document."""
    return quality.quality(read(spark, folder, "documents"))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    docs, items = read(spark, folder, "documents"), read(spark, folder, "benchmark")
    return ranked_search.search(docs, items)


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents with the form each is a variant of."""
    return spelling.variants(read(spark, folder, "documents"))


def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document that stand in windows of benchmark items."""
    docs, items = read(spark, folder, "documents"), read(spark, folder, "benchmark")
    return decontaminate.contamination(docs, items)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_mixing,
        op3_licenses,
        op4_pii,
        op5_syncmers,
        op6_byte_bpe,
        op7_simhash,
        op8_url_filter,
        op9_warc,
        op10_quality,
        op11_ranked_search,
        op12_spelling_variants,
        op13_decontamination,
    )
}
SQL: dict[str, str] = dict(sql.SQL)

"""From raw documents to token ids in five stages, each written and read again.

Quality rules, removal of boilerplate lines, near-duplicates, mixing of sources to
target weights, byte-level BPE.  A stage takes all that the one before kept.

Null and empty texts fail the quality rules, very long ones are judged whole like any
other, repeated rows are one document from the near-duplicates on (equal ties go to the
smallest id), an empty table stays empty through all stages, and extra columns are handed
on under their own names whatever these are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaymart.llm import bpe, line_dedup, mixing, quality, simhash
from quaymart.llm.common import read, stored

#: No single statement: fingerprints, rounding and token ids are not SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all rules."""
    return quality.keep_good(docs)


def line_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many sources share."""
    return line_dedup.cleaned(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group whose fingerprints are linked, as in ``op7_simhash``."""
    return simhash.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and hashes of them and of what they decode to."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_removal),
    ("simhash near-dedup", near_dedup),
    ("source mix", source_mix),
    ("byte-level bpe", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"stage-{i}")
    return docs

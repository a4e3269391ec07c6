"""Removal of boilerplate: lines that many sites share.

The spread of a line is the number of distinct sites it occurs on.  HyperLogLog
sketches of the sites, one a line, are merged by aggregation; lines whose estimate
is near the threshold are counted exactly.  The first occurrence of a line stays, so
that no content is lost from the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymart.llm.common import (
    WORD,
    quoted,
    stored,
    text_key,
    text_or_empty,
    where_computed,
    word_array,
)

MIN_SITES, MIN_WORDS, LG_K = 5, 3, 12


def _lines(docs: DataFrame, site_column: str) -> DataFrame:
    """A row for each line: where it stands, its site, and what names its content.

    Two hashes and the length stand for the line, trimmed of spaces at both ends.
    """
    lines = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key("text").alias("text_hash"),
        F.xxhash64(F.coalesce(F.col(quoted(site_column)), F.lit(""))).alias("site"),
        F.posexplode(F.split(text_or_empty("text"), "\n")).alias("position", "line"),
    )
    line = F.btrim("line", F.lit(" \t\x0b\f\r"))
    return lines.select(
        "doc_id",
        "text_hash",
        "site",
        "position",
        F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"), F.length(line).alias("n")).alias(
            "line"
        ),
        F.size(word_array(line)).alias("n_words"),
    )


def boilerplate(
    docs: DataFrame,
    site_column: str = "source",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """Lines of ``min_words`` or more on ``min_sites`` or more sites: ``line, first``.

    A null site is the site of the empty name.
    """
    lines = _lines(docs, site_column).where(F.col("n_words") >= min_words)
    place = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "text_hash", "position")
    spread = stored(
        lines.groupBy("line")
        .agg(F.hll_sketch_agg("site", LG_K).alias("sketch"), F.min(place).alias("first"))
        .select("line", "first", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= min_sites - _margin(min_sites)),
        "spread",
    )
    near = F.abs(F.col("sites") - min_sites) <= _margin(min_sites)
    exact = (
        lines.select("line", "site")
        .join(spread.where(near).select("line"), "line", "left_semi")
        .distinct()
        .groupBy("line")
        .agg(F.count("*").alias("exact"))
    )
    return (
        spread.join(exact, "line", "left")
        .where(F.coalesce("exact", "sites") >= min_sites)
        .select("line", "first")
    )


def _margin(min_sites: int) -> int:
    """Four standard errors of the sketch, one at least."""
    return max(1, math.ceil(min_sites * 4 * 1.04 / math.sqrt(2**LG_K)))


def _without(text: Column, removed: Column) -> Column:
    lines = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
    return F.when(removed.isNull(), text).otherwise(
        F.array_join(F.transform(F.array_sort(kept), lambda i: F.get(lines, i)), "\n")
    )


def dedup_lines(
    docs: DataFrame,
    site_column: str = "source",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """All rows as ``row``, the text without boilerplate, ``n_lines`` and ``n_removed``.

    A null text is an empty one: one empty line, none removed.  Rows of equal id and
    text are one document: they keep or lose the same lines.  Of a line's places the one of
    the smallest id stays, nulls last, then by text and position.  Very long texts are cut
    into lines whole; an empty table gives no row; all columns are in ``row``, so their names
    clash with nothing.
    """
    common = stored(boilerplate(docs, site_column, min_sites, min_words), "boilerplate")
    here = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "text_hash", "position")
    lost = (
        _lines(docs, site_column)
        .join(common, "line")
        .where(here != F.col("first"))
        .groupBy(F.col("doc_id").alias("lost_id"), F.col("text_hash").alias("lost_hash"))
        .agg(F.collect_set("position").alias("removed"))
    )
    rows = docs.select(F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row"))
    text = text_or_empty(F.col("row.text"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("lost_id")) & (
        text_key(F.col("row.text")) == F.col("lost_hash")
    )
    return rows.join(lost, same, "left").select(
        "row",
        _without(text, F.col("removed")).alias("text"),
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
    )


def cleaned(docs: DataFrame) -> DataFrame:
    """Documents without boilerplate, ``n_chars`` counted anew if there is one.

    A document left without a word by the removal goes: other documents hold all its
    lines.  Documents that lose nothing are unchanged.
    """
    found = where_computed(
        dedup_lines(docs), (F.col("n_removed") == 0) | F.col("text").rlike(WORD)
    )
    new = {
        "text": F.when(F.col("n_removed") == 0, F.col("row.text")).otherwise(F.col("text")),
        "n_chars": F.when(F.col("n_removed") > 0, F.length("text").cast("long")),
    }
    columns = []
    for name in docs.columns:
        old = F.col(f"row.{quoted(name)}")
        if name == "text":
            old = new["text"]
        elif name == "n_chars":
            old = F.coalesce(new["n_chars"], old)
        columns.append(old.alias(name))
    return found.select(*columns)

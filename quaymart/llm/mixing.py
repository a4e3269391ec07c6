"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with target ``t`` and size ``s`` is to be taken ``t / s``
times.  The whole part is taken as it is; the fractions are rounded in pairs: a
random transfer of mass (words, so that the source's total stays) makes one of two
fractions 0 or 1, and the other goes on.  Documents are dealt over leaves of bounded
size, each leaf leaves one fraction, and these are combined in the same way level by
level.  Only ids and sizes are moved, never texts.
"""

from __future__ import annotations

import hashlib
import random
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quaymart.llm.common import WORD, quoted, stored, text_key, text_or_empty

WEIGHTS, SHARE, MOST, LEAF, SEED = (5, 2, 1), 1.5, 2.0, 4096, 42
# Equal rows go to a leaf this many at a time.
BUNDLE = 64


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source_size, target`` of each source from rows with ``source`` and ``size``.

    Sources in code point order, null last, weigh :data:`WEIGHTS` in turn and share
    ``share`` of all words.  A target stops at ``most`` times the source's size; what
    is over goes to the others by weight, until none is above.
    """
    by_source = stored(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources"
    )
    # One row a source: the order needs them in one place, the documents don't.
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*map(F.lit, WEIGHTS))
    ranked = stored(
        by_source.withColumn("weight", F.get(weights, rank % len(WEIGHTS)))
        .withColumn("most", F.col("source_size") * F.lit(float(most))),
        "weights",
    )
    total = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        # Words a unit of weight gets if the sources full at this level stay full.
        full = F.col("most") <= F.col("weight") * F.lit(level)
        row = ranked.agg(
            F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        new = (total - (row[0] or 0)) / row[1] if row[1] else level
        if not row[1] or new <= level:
            break
        level = new
    return ranked.select(
        "source",
        "source_size",
        F.least("most", F.col("weight") * F.lit(level)).alias("target"),
    )


def round_pairs(sizes: list[int], fractions: list[float], seed: str) -> list[float]:
    """Fractions after pairing in order; all are 0 or 1 but one at most.

    ``size * fraction`` is moved, so its sum stays, and each fraction's mean too.
    """
    uniform = random.Random(int.from_bytes(hashlib.sha256(seed.encode()).digest()[:8])).random
    result = list(fractions)
    held = -1
    for i, size in enumerate(sizes):
        if size == 0:
            result[i] = float(result[i] >= 0.5)
        if not 0.0 < result[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        p, q, a, b = result[held], result[i], sizes[held], size
        up = min((1 - p) * a, q * b)  # words to move to the one held
        down = min(p * a, (1 - q) * b)
        if uniform() * (up + down) < down:
            done = up == (1 - p) * a, up == q * b
            p = 1.0 if done[0] else p + up / a
            q = 0.0 if done[1] else q - up / b
        else:
            done = down == p * a, down == (1 - q) * b
            p = 0.0 if done[0] else p - down / a
            q = 1.0 if done[1] else q + down / b
        result[held], result[i] = p, q
        if not 0.0 < p < 1.0:
            held = i if 0.0 < q < 1.0 else -1
    return result


def _leaf(frame: pd.DataFrame) -> pd.DataFrame:
    """Round one leaf, large documents first, so that a small one is left over."""
    frame = frame.loc[frame.index.repeat(frame["n"])].assign(n=1)
    frame = frame.sort_values(["size", "doc_id", "text_hash"], ascending=[False, True, True])
    first = frame.iloc[0]
    seed = f"{SEED}:{first['source']}:{first['leaf']}:{first['level']}"
    frame["part"] = round_pairs(frame["size"].tolist(), frame["part"].tolist(), seed)
    return frame


COLUMNS = (
    "source string, doc_id long, text_hash long, size long, part double, n long, leaf long, level int"
)


def _bundles(rows: DataFrame, bundle: int) -> DataFrame:
    """Different rows with ``n`` of the equal ones, at most ``bundle``, and the bundle's number.

    Equal rows are counted in each task first, and it does not matter which of them is
    in which bundle: the same rows give the same bundles.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("rows"))
    batch = bundle * 4096  # rows of a batch of bundles, so that no array grows with the rows
    step = F.explode(F.expr(f"sequence(0L, (rows - 1) div {batch})")).alias("step")
    last = F.least(F.lit(4095), F.expr(f"(rows - 1 - step * {batch}) div {bundle}"))
    within = F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("within")
    return (
        counted.select("*", step)
        .select("*", within)
        .withColumn("bundle", F.col("step") * 4096 + F.col("within"))
        .withColumn("n", F.least(F.lit(bundle), F.col("rows") - F.col("bundle") * bundle).cast("long"))
        .drop("rows", "step", "within")
    )


def copies(docs: DataFrame, leaf: int = LEAF, share: float = SHARE, most: float = MOST) -> DataFrame:
    """How often each row is taken.

    Rows are dealt over leaves by hash, equal ones in bundles, so that no leaf holds all of
    them.  Returns ``doc_id, text_hash, source, size, source_size, target, copies``.  A null
    text has no words and a null source is a source.  A run with the same rows takes
    the same copies.  Rows of equal id and text may differ in their copies, which of them
    takes more is a tie that the order within a leaf settles.  Very long texts count by all
    their words; an empty table gives no row; columns other than ``doc_id, text, source``
    are ignored, whatever their names.
    """
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            text_key("text").alias("text_hash"),
            F.col("source").cast("string").alias("source"),
            n_words(text_or_empty("text")).alias("size"),
        ),
        "sizes",
    )
    goals = stored(targets(rows, share, most), "targets")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    goals = goals.withColumn("rate", F.coalesce(wanted, F.lit(0.0)))
    counts = rows.groupBy("source").agg(F.count("*").alias("n"))
    plan = stored(
        goals.join(counts, goals["source"].eqNullSafe(counts["source"]))
        .select(goals["source"].alias("of"), "rate", F.ceil(F.col("n") / leaf).alias("leaves")),
        "leaves",
    )
    bundles = _bundles(rows, min(BUNDLE, max(1, leaf // 64)))
    open_rows = bundles.join(plan, bundles["source"].eqNullSafe(plan["of"])).select(
        "source",
        "doc_id",
        "text_hash",
        "size",
        (F.col("rate") - F.floor("rate")).alias("part"),
        "n",
        F.pmod(F.xxhash64("doc_id", "text_hash", F.lit("leaf"), "bundle"), "leaves").alias("leaf"),
        F.lit(0).alias("level"),
    )
    deepest = plan.agg(F.max("leaves")).first()[0] or 0
    done: list[DataFrame] = []
    level = 0
    while True:
        rounded = stored(
            open_rows.groupBy("source", "leaf").applyInPandas(_leaf, COLUMNS), f"level-{level}"
        )
        whole = F.col("part").isin(0.0, 1.0)
        done.append(rounded.where(whole))
        level += 1
        if deepest <= 1:
            done.append(rounded.where(~whole).withColumn("part", F.round("part")))
            break
        deepest = -(-deepest // leaf)
        open_rows = rounded.where(~whole).select(
            "source",
            "doc_id",
            "text_hash",
            "size",
            "part",
            "n",
            F.floor(F.col("leaf") / leaf).alias("leaf"),
            F.lit(level).alias("level"),
        )
    result = reduce(DataFrame.unionByName, done)
    goal = goals.withColumnRenamed("source", "of")
    return result.join(goal, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id",
        "text_hash",
        "source",
        "size",
        "source_size",
        "target",
        (F.floor("rate") + F.col("part")).cast("long").alias("copies"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """The documents of the mix: each row as often as it is taken, with all its columns."""
    taken = (
        copies(docs)
        .where("copies > 0")
        .groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.col("source").alias("of"))
        .agg(F.sum("copies").alias("copies"))
    )
    rows = docs.select(F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row"))
    same = (
        F.col("row.doc_id").cast("long").eqNullSafe(F.col("id"))
        & (text_key(F.col("row.text")) == F.col("hash"))
        & F.col("row.source").eqNullSafe(F.col("of"))
    )
    one = rows.join(taken, same).dropDuplicates(["id", "hash", "of"])
    return one.select(
        "row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    ).select(*(F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns))

"""Ranked lexical search: the best documents of each query item, by presence masks.

Scores are sums of a term's weight times a factor of its count in the document, in whole
numbers.  A document's mask holds one bit for each term of an item.  A task keeps the best
documents of each item so far.  Of each batch it makes the masks with bitmap operations,
groups the item's documents by mask, and evaluates the different masks by descending maximum
score; it stops when the next maximum is below the last score kept, so no document that
could enter is passed over.  What the tasks keep is ranked once more.

Items are taken in blocks of a bounded number of terms; documents are scanned block by block
and neither side is ever held whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaymart.llm.common import byte_words, quoted, slices, stored, text_key, text_or_empty

BEST, BLOCK_TERMS, BATCH, CELLS = 10, 1 << 18, 1024, 1 << 21
SCALE, UNIT, FLAT = 1_000_000_000, 1000, 8
SHORT, PER_LENGTH = 100 - 90, 90


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, text_hash, terms`` of the different items: their different terms."""
    schema = "item_id long, text_hash long, terms array<binary>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100):
            terms = [sorted(set(byte_words(t.as_py()))) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.binary()))],
                ["item_id", "text_hash", "terms"],
            )

    rows = items.select(
        F.col(quoted("item_id")).cast("long").alias("item_id"),
        text_key("text").alias("text_hash"),
        text_or_empty("text").cast("binary").alias("text"),
    )
    return rows.dropDuplicates(["item_id", "text_hash"]).mapInArrow(run, schema)


def counted(docs: DataFrame, numbers) -> DataFrame:
    """``doc_id, n, terms, counts``: length and occurrences of the numbered terms in each row."""
    schema = "doc_id long, n long, terms array<int>, counts array<int>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value
        for batch in slices(batches, 500):
            lengths, terms, counts = [], [], []
            for text in batch.column(1):
                words = byte_words(text.as_py())
                found = Counter(filter(number.__contains__, words))
                lengths.append(len(words))
                terms.append([number[w] for w in found])
                counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lengths, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int32())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    rows = docs.select(
        F.col(quoted("doc_id")).cast("long").alias("doc_id"),
        text_or_empty("text").cast("binary").alias("text"),
    )
    return rows.mapInArrow(run, schema)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def factors(counts: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What each occurrence count gives per unit of weight, by the length of its document."""
    m = SHORT + (PER_LENGTH * lengths * n_docs) // n_terms
    return (SCALE * counts) // (UNIT * counts + FLAT * m)


class Best:
    """The best documents of one item so far: highest score, then smallest id, nulls last."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.scores = np.empty(0, np.int64)
        self.no_id = np.empty(0, bool)
        self.ids = np.empty(0, np.int64)

    def least(self) -> int:
        """A score below this cannot enter."""
        return int(self.scores[-1]) if len(self.scores) == self.size else 1

    def take(self, scores: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least()
        if good.any():
            scores = np.concatenate([self.scores, scores[good]])
            no_id = np.concatenate([self.no_id, no_id[good]])
            ids = np.concatenate([self.ids, ids[good]])
            order = np.lexsort((ids, no_id, -scores))[: self.size]
            self.scores, self.no_id, self.ids = scores[order], no_id[order], ids[order]


def evaluate(
    best: Best, docs: np.ndarray, column: np.ndarray, gains: np.ndarray, n_terms: int,
    no_id: np.ndarray, ids: np.ndarray,
) -> int:
    """Take an item's documents of a batch into ``best``, mask by mask; how many were scored.

    An occurrence is given by document, column of the item's term, and gain (weight times
    factor); ``no_id`` and ``ids`` belong to the documents.
    """
    present, at = np.unique(docs, return_inverse=True)
    table = np.zeros((len(present), n_terms), np.int64)
    held = np.zeros((len(present), n_terms), bool)
    table[at, column] = gains
    held[at, column] = True
    masks = np.packbits(held, axis=1)
    whole = np.ascontiguousarray(masks).view([("", masks.dtype, masks.shape[1])]).ravel()
    _, first, group = np.unique(whole, return_index=True, return_inverse=True)
    # The most that any document of the batch gains by each term bounds a mask's score.
    bounds = held[first].astype(np.int64) @ table.max(axis=0)
    order = np.argsort(-bounds, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    by_rank = np.argsort(rank[group], kind="stable")
    ends = np.cumsum(np.bincount(rank[group], minlength=len(order)))
    done, begin, step = 0, 0, 8
    while done < len(order) and bounds[order[done]] >= best.least():
        # A few masks at once, more each time, but none below what can enter.
        until = min(len(order), done + step)
        while bounds[order[until - 1]] < best.least():
            until -= 1
        rows = by_rank[begin : ends[until - 1]]
        best.take(table[rows].sum(axis=1), no_id[present[rows]], ids[present[rows]])
        done, begin, step = until, int(ends[until - 1]), 2 * step
    return begin


def ranked(counts: DataFrame, block, n_docs: int, n_terms: int, size: int = BEST) -> DataFrame:
    """``item_id, text_hash, doc_id, score``: each task's best documents of each item.

    ``block`` is broadcast: the items as ``(item_id, text_hash, numbers of terms)`` and the
    weight of each number.
    """
    schema = pa.schema(
        [("item_id", pa.int64()), ("text_hash", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = block.value
        best = [Best(size) for _ in items]
        for batch in slices(batches, BATCH):
            no_id = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            lengths = batch.column(1).to_numpy(zero_copy_only=False)
            terms, held = batch.column(2), batch.column(3)
            docs = np.repeat(np.arange(len(ids)), terms.value_lengths().to_numpy(zero_copy_only=False))
            terms = terms.flatten().to_numpy(zero_copy_only=False)
            held = held.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if not len(terms):
                continue
            gains = weights[terms] * factors(held, lengths[docs], n_docs, n_terms)
            # Occurrences in the order of terms, and where those of each term begin.
            order = np.argsort(terms, kind="stable")
            docs, gains, terms = docs[order], gains[order], terms[order]
            for own, (_, _, numbers) in zip(best, items, strict=True):
                start = np.searchsorted(terms, numbers, "left")
                n = np.searchsorted(terms, numbers, "right") - start
                if not n.any():
                    continue
                at = np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
                column = np.repeat(np.arange(len(numbers)), n)
                rows = max(1, CELLS // len(numbers))  # documents of a table at once
                for lo in range(0, len(ids), rows):
                    part = at, column
                    if rows < len(ids):
                        inside = (docs[at] >= lo) & (docs[at] < lo + rows)
                        part = at[inside], column[inside]
                    if len(part[0]):
                        evaluate(own, docs[part[0]], part[1], gains[part[0]], len(numbers), no_id, ids)
        for own, (item_id, text_hash, _) in zip(best, items, strict=True):
            n = len(own.scores)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item_id] * n, pa.int64()),
                        pa.array([text_hash] * n, pa.int64()),
                        pa.array(own.ids, mask=own.no_id),
                        pa.array(own.scores),
                    ],
                    schema=schema,
                )

    return counts.mapInArrow(run, "item_id long, text_hash long, doc_id long, score long")


def search(
    docs: DataFrame, items: DataFrame, size: int = BEST, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``size`` best documents of each item.

    Every row of ``docs`` is a document, so a repeated one takes a rank each time; null,
    empty and wordless texts hold no terms and count neither as documents nor as terms, very
    long ones are counted whole.  Equal scores are ranked by ascending ``doc_id``, nulls
    last.  Of equal rows of ``items`` one is taken, rows of one id and different texts are
    ranked apart.  An item without a term, or without a document of a score above 0, has no
    row; empty tables give none.  Columns other than id and text are ignored.
    """
    spark = docs.sparkSession
    queries = stored(item_terms(items), "item-terms")
    total = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / block_terms))
    block_of = F.pmod(F.xxhash64("item_id", "text_hash"), F.lit(n_blocks))
    parts = []
    for block in range(n_blocks):
        # About ``block_terms`` terms, whatever the number of items.
        rows = queries.where(block_of == block).where(F.size("terms") > 0).collect()
        vocabulary = sorted({bytes(t) for r in rows for t in r["terms"]})
        number = {t: i for i, t in enumerate(vocabulary)}
        counts = stored(counted(docs, spark.sparkContext.broadcast(number)), "counts")
        sums = counts.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
        if not sums["docs"] or not rows:
            continue
        held = counts.select(F.explode("terms").alias("term")).groupBy("term").count()
        weights = np.zeros(len(vocabulary), np.int64)
        for r in held.collect():  # a row for each term of the block
            weights[r["term"]] = weight(sums["docs"], r["count"])
        own = [
            (r["item_id"], r["text_hash"], np.array([number[bytes(t)] for t in r["terms"]], np.int32))
            for r in rows
        ]
        shared = spark.sparkContext.broadcast((own, weights))
        parts.append(ranked(counts, shared, sums["docs"], sums["terms"], size))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("item_id", "text_hash").orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last()
    )
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= size)
        .select("item_id", "rank", "doc_id", "score")
    )

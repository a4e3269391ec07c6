"""Benchmark decontamination by winnowing.

A window is a run of words of a benchmark item, and a text keeps of each of its windows the
smallest hash among the shorter runs of words (grams) within it.  Equal windows have equal
grams, so a document that holds a window keeps the gram that the item keeps, at the same
place within it: the join of the two sets of kept grams misses no window.  A hit is extended
to the windows around its gram, which are compared word by word.

Items of fewer words than a window are one window of their own size, and documents are
winnowed once for each size that occurs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.llm.common import byte_words, quoted, slices, stored, text_key, text_or_empty

WINDOW = 10
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Bits of the filter a kept gram of the benchmark, and the least and the most bits at all
#: (as powers of two): 16 MB at most, whatever the benchmark.  A full filter passes grams
#: that the join then drops.
FILTER_BITS, FILTER_LEAST, FILTER_MOST = 16, 16, 27


def shape(size: int) -> tuple[int, int]:
    """Words a gram, and grams a window, of windows of ``size`` words."""
    gram = (size + 1) // 2
    return gram, size - gram + 1


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the grams of windows of ``size`` words, from the hashes of the words."""
    gram, _ = shape(size)
    n = max(0, len(words) - gram + 1)
    found = np.full(n, size, np.uint64)
    for i in range(gram):
        found = found * _FACTOR + words[i : i + n]
    found = (found ^ (found >> np.uint64(31))) * _MIX
    return found ^ (found >> np.uint64(29))


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def kept_grams(grams: np.ndarray, per_window: int) -> np.ndarray:
    """For each window the place of its smallest gram, the first of equal ones."""
    if len(grams) < per_window:
        return np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(grams, per_window)
    return windows.argmin(axis=1) + np.arange(len(windows))


def _joined(words: Sequence[bytes]) -> str:
    return b" ".join(words).decode("utf-8", "replace")


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, size, anchor, window`` of every window: its kept gram and its words."""
    schema = pa.schema(
        [("item_id", pa.int64()), ("size", pa.int32()), ("anchor", pa.int64()), ("window", pa.string())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            words = byte_words(batch.column(1)[0].as_py())
            if not words:
                continue
            size = min(len(words), window)
            grams = gram_hashes(word_hashes(words), size)
            anchors = grams[kept_grams(grams, shape(size)[1])].view(np.int64)
            for start in range(0, len(anchors), 10_000):
                part = anchors[start : start + 10_000]
                texts = [_joined(words[start + i : start + i + size]) for i in range(len(part))]
                ids = [batch.column(0)[0].as_py()] * len(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array([size] * len(part), pa.int32()),
                        pa.array(part),
                        pa.array(texts, pa.string()),
                    ],
                    schema=schema,
                )

    rows = items.select(
        F.col(quoted("item_id")).cast("long").alias("item_id"),
        text_or_empty("text").cast("binary").alias("text"),
    )
    return rows.mapInArrow(run, "item_id long, size int, anchor long, window string")


def gram_filter(anchors: DataFrame) -> np.ndarray:
    """A Bloom filter of two bits a kept gram, built by aggregation; its size is bounded."""
    wanted = max(1, anchors.count() * FILTER_BITS)
    bits = 1 << min(max(math.ceil(math.log2(wanted)), FILTER_LEAST), FILTER_MOST)
    places = F.array(
        F.col("anchor").bitwiseAND(F.lit(bits - 1)),
        F.shiftrightunsigned("anchor", 32).bitwiseAND(F.lit(bits - 1)),
    )
    words = (
        anchors.select(F.explode(places).alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("bits"))
    )
    found = np.zeros(bits // 64, np.int64)
    for row in words.collect():  # at most one row for 64 bits
        found[row["word"]] = row["bits"]
    return found.view(np.uint64)


def passing(grams: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which grams the filter may hold."""
    mask = np.uint64(64 * len(held) - 1)
    found = np.ones(len(grams), bool)
    for place in (grams & mask, (grams >> np.uint64(32)) & mask):
        found &= (held[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


_HITS = "array<struct<anchor: long, size: int, start: int, words: array<string>>>"


def winnowed(docs: DataFrame, sizes: Sequence[int], held) -> DataFrame:
    """``doc_id, text_hash, n_words, hits`` of every row.

    A hit is a kept gram that passes the filter, with the words of all windows around it.
    ``held`` is the broadcast filter.
    """
    hit = pa.struct(
        [
            ("anchor", pa.int64()),
            ("size", pa.int32()),
            ("start", pa.int32()),
            ("words", pa.list_(pa.string())),
        ]
    )

    def hits(words: list[bytes]) -> list[dict]:
        found = []
        hashes = word_hashes(words) if sizes and len(words) >= min(sizes) else ()
        for size in sizes:
            if len(words) < size:
                continue
            per_window = shape(size)[1]
            grams = gram_hashes(hashes, size)
            at = np.unique(kept_grams(grams, per_window))
            for p in at[passing(grams[at], held.value)].tolist():
                start = max(0, p - per_window + 1)
                around = [w.decode("utf-8", "replace") for w in words[start : p + size]]
                anchor = int(grams[p].view(np.int64))
                found.append({"anchor": anchor, "size": size, "start": start, "words": around})
        return found

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            words = [byte_words(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(map(len, words), pa.int64()),
                    pa.array(map(hits, words), pa.list_(hit)),
                ],
                ["doc_id", "text_hash", "n_words", "hits"],
            )

    rows = docs.select(
        F.col(quoted("doc_id")).cast("long").alias("doc_id"),
        text_key("text").alias("text_hash"),
        text_or_empty("text").cast("binary").alias("text"),
    )
    return rows.mapInArrow(run, f"doc_id long, text_hash long, n_words long, hits {_HITS}")


def covered(spans):
    """Words within an array of sorted ``start, end``."""
    none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        spans,
        none,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], acc["end"]))).alias("n"),
            F.greatest(acc["end"], x["end"]).alias("end"),
        ),
        lambda acc: acc["n"].cast("long"),
    )


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, spans, items`` of every row of ``docs``.

    ``spans`` are the sorted word ranges ``start, end`` of the windows met, ``items`` the
    sorted ids, as text, of the items they belong to; both null without any.
    """
    spark = docs.sparkSession
    windows = stored(item_windows(items, window), "windows")
    own = windows.select("size", "anchor", "window").distinct()
    own = stored(own.withColumn("number", F.monotonically_increasing_id()), "own-windows")
    of_items = windows.join(own, ["size", "anchor", "window"]).select("number", "item_id").distinct()
    sizes = sorted(r["size"] for r in own.select("size").distinct().collect())  # 10 at most
    held = spark.sparkContext.broadcast(gram_filter(own.select("anchor").distinct()))
    rows = stored(winnowed(docs, sizes, held), "winnowed")

    around = F.transform(
        F.sequence(F.lit(0), F.size("hit.words") - F.col("hit.size")),
        lambda i: F.struct(
            (F.col("hit.start") + i).alias("start"),
            F.array_join(F.slice("hit.words", i + 1, F.col("hit.size")), " ").alias("window"),
        ),
    )
    found = (
        rows.select("doc_id", "text_hash", F.explode("hits").alias("hit"))
        .select("doc_id", "text_hash", "hit.anchor", "hit.size", F.explode(around).alias("w"))
        .select("doc_id", "text_hash", "anchor", "size", "w.start", "w.window")
        .join(own, ["anchor", "size", "window"])
        .select("doc_id", "text_hash", "start", (F.col("start") + F.col("size")).alias("end"), "number")
    )
    found = stored(found, "found")
    spans = found.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans")
    )
    item = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    met = (
        found.select("doc_id", "text_hash", "number")
        .distinct()
        .join(of_items, "number")
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set(item)).alias("items"))
    )
    same = F.col("d.doc_id").eqNullSafe(F.col("o.doc_id")) & (
        F.col("d.text_hash") == F.col("o.text_hash")
    )
    both = spans.alias("d").join(met.alias("o"), same).select(
        F.col("d.doc_id").alias("doc_id"), F.col("d.text_hash").alias("text_hash"), "spans", "items"
    )
    return rows.alias("d").join(both.alias("o"), same, "left").select(
        "d.doc_id", "d.n_words", "o.spans", "o.items"
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words of every document that stand in a window of a benchmark item, and the items.

    A null or empty text has no words, on either side; a document of fewer words than an
    item's window cannot hold it.  Very long texts are winnowed whole.  Repeated rows of
    ``docs`` have the same result each time; items of one id, null among them, are one item,
    and repeated ones change nothing.  Without items nothing is hit, without documents there
    are no rows.  Columns other than id and text are ignored, whatever their names.
    """
    none = F.array().cast("array<string>")
    n_hit = F.coalesce(covered(F.col("spans")), F.lit(0).cast("long"))
    met = F.coalesce("items", none)
    return matches(docs, items, window).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(met).cast("long").alias("n_items"),
        F.sha2(F.array_join(met, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )

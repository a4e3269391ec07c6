"""Document fingerprints from closed syncmers.

A k-mer of code points is an anchor if the smallest hash of its s-mers stands at its
first or last place; whether it is one depends on its own characters alone.  A
fingerprint holds every anchor of a text with its first position: it grows with the text,
and whether an anchor is held does not depend on what stands elsewhere.  Two fingerprints
are compared by the anchors they share on one diagonal.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.llm.common import text_or_empty

K, S = 16, 6
#: Texts of any number of different anchors keep all: no 32 bits of a hash reach the bound.
SHORT, BOUND = sys.maxsize, 1 << 32
_CHUNK = 1 << 20  # code points hashed at once
_HELD = 1 << 24  # characters of fingerprints in a batch, beyond which it is handed on
_BASE, _ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    """A polynomial hash of every run of n code points, built by doubling."""
    result, width = None, 0
    part, size, factor = codes, 1, _BASE
    while n:
        if n & 1:
            if result is None:
                result, width = part, size
            else:
                length = len(codes) - width - size + 1
                result = result[:length] * np.uint64(factor) + part[width : width + length]
                width += size
        n >>= 1
        if n:
            part = part[: len(part) - size] * np.uint64(factor) + part[size:]
            size, factor = 2 * size, factor * factor & _ALL
    return result


def _least(values: np.ndarray, window: int) -> np.ndarray:
    """The minimum of every window, by doubling."""
    size, least = 1, values
    while 2 * size <= window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = window - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of all closed syncmers.

    A text without one, such as one shorter than ``k``, is an anchor as a whole.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    hashes, positions = [], []
    for start in range(0, len(codes) - k + 1, _CHUNK):
        part = codes[start : start + _CHUNK + k - 1].astype(np.uint64) + np.uint64(1)
        small = _mixed(_grams(part, s))
        least = _least(small, k - s + 1)
        n = len(least)
        at = np.flatnonzero((small[:n] == least) | (small[k - s : k - s + n] == least))
        hashes.append(_mixed(_grams(part, k)[at]))
        positions.append(at + start)
    if not any(map(len, hashes)):
        whole = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        return np.array([int.from_bytes(whole)], np.uint64), np.zeros(1, np.int64)
    return np.concatenate(hashes), np.concatenate(positions)


Sketch = tuple[np.ndarray, np.ndarray]


def sketch(text: str) -> Sketch:
    """All anchors by 32 bits of hash, and their first positions."""
    hashes, positions = anchors(text)
    found, first = np.unique((hashes >> np.uint64(32)).astype(np.int64), return_index=True)
    return found, positions[first]


def encoded(sketched: Sketch) -> str:
    """Hash and position of each anchor in hexadecimal, by hash."""
    pairs = np.stack(sketched, axis=1).ravel().tolist()
    return ".".join(["%08x%x"] * len(sketched[0])) % tuple(pairs)


def decoded(text: str) -> Sketch:
    """The anchors of a fingerprint."""
    held = [(int(x[:8], 16), int(x[8:], 16)) for x in text.split(".")]
    hashes, positions = np.array(held, np.int64).T
    return hashes, positions


def likeness(a: Sketch, b: Sketch) -> float:
    """Share of anchors in common on one diagonal, 0 to 1 (Dice's measure).

    Of anchors in both, the ones count whose shift is within an eighth of the texts'
    length of the median shift.
    """
    (x, at_x), (y, at_y) = a, b
    reach = max(int(at_x.max()), int(at_y.max())) / 8 + K
    shared, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    shift = at_x[i] - at_y[j]
    matched = int((np.abs(shift - np.median(shift)) <= reach).sum())
    return 2 * matched / (len(x) + len(y))


def fingerprint(text: str) -> str:
    """The fingerprint of a text; equal texts have equal ones."""
    return encoded(sketch(text))


def in_order(docs: DataFrame) -> DataFrame:
    """Rows ``part, guest, doc_id, text`` such that a part's rows come in order of id.

    A part ends with a guest: the first row of the next part, or of all rows for the
    last, so each row stands before the one that follows it.  Parts are ranges of
    ``doc_id`` (nulls first, then ties by text) between quantiles, as many as the session
    has shuffle partitions, and each is one partition.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text")
    )
    ids = rows.select("doc_id")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = ids.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (4 * n)) if n > 1 else []
    cuts = sorted({int(c) for c in cuts})
    part = _part(F.col("doc_id"), cuts)
    starts = ids.groupBy(part.alias("part")).agg(
        F.min("doc_id").alias("first"), F.max(F.isnull("doc_id")).alias("null_first")
    )
    # One row a part, whatever the number of rows.
    firsts = sorted(starts.collect())
    hosts = {}  # first id of a part -> the part that ends with it
    for i, row in enumerate(firsts):
        before = firsts[i - 1]
        hosts[None if row["null_first"] else row["first"]] = before["part"]
    host = F.lit(None).cast("int")
    if None in hosts:
        host = F.when(F.isnull("doc_id"), F.lit(hosts[None]))
    known = {k: v for k, v in hosts.items() if k is not None}
    if known:
        table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
        host = F.coalesce(host, F.element_at(table, F.col("doc_id")))
    placed = rows.select(
        F.explode(
            F.filter(
                F.array(
                    F.struct(part.alias("part"), F.lit(0).alias("guest")),
                    F.when(host.isNotNull(), F.struct(host.alias("part"), F.lit(1).alias("guest"))),
                ),
                lambda x: x.isNotNull(),
            )
        ).alias("at"),
        "doc_id",
        "text",
    ).select("at.part", "at.guest", "doc_id", "text")
    return placed.repartitionById(n, F.col("part")).sortWithinPartitions("part", "guest", "doc_id", "text")


def _part(doc_id, cuts: list[int]):
    """The number of cuts at or below an id, by halving; null is in part 0."""

    def of(low: int, high: int):
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(doc_id >= cuts[middle], of(middle + 1, high)).otherwise(of(low, middle))

    return of(0, len(cuts))


def _compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    ]
    held = None  # part, id, text and sketch of the row before
    for batch in batches:
        out, size = [], 0
        for part, guest, doc_id, text in zip(
            *(batch.column(i).to_pylist() for i in range(4)), strict=True
        ):
            if held and held[0] != part:
                held = None
            if guest and held is None:
                continue  # a second guest of this part
            own = sketch(text)
            if held:
                out.append(_row(held, text, own))
                size += len(out[-1][3]) + len(out[-1][4])
            held = None if guest else (part, doc_id, text, own)
            if len(out) >= 500 or size >= _HELD:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*out, strict=True)], names
                )
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by the start of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _row(held: tuple, following: str, next_sketch: tuple) -> tuple:
    _, doc_id, text, own = held
    changed = edited(text, following)
    other = sketch(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        encoded(own),
        encoded(other),
        likeness(own, other),
        likeness(own, next_sketch),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how near they are.

    A null text is an empty one; very long texts are taken whole, in pieces.  Of repeated
    ids, each row is followed by the next in order of text, and equal rows follow each
    other; a single row is followed by itself.  An empty table gives no row; columns other
    than ``doc_id, text`` are ignored, whatever their names.
    """
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return in_order(docs).mapInArrow(_compared, schema)

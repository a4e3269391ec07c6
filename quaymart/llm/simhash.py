"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

Fingerprints are cut into ``blocks``; two that differ in at most ``bits`` bits agree
on ``blocks - bits`` of them, so each fingerprint is put under every choice of that
many blocks and compared only with those under the same value.  What is compared may
be longer than what is cut: further words of the fingerprint tell a similar text from
a stranger, so pairs that share a key are linked beyond ``bits`` too.  Texts with one
fingerprint are one node from the start.  Within a block only a spanning forest of
the links is passed on, and crowded blocks are cut into pieces that are compared two
by two, so no task gets an unbounded group and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymart.llm.common import (
    quoted,
    slices,
    stored,
    text_key,
    text_or_empty,
)
from quaymart.llm.components import components

SHINGLE, BITS, BLOCKS, PIECE, SEED = 4, 4, 7, 4096, 42
_MASK = (1 << 64) - 1
_NARROW = 64  # groups up to this size are compared at once
_CHUNK = 1 << 15  # shingles whose bits are unpacked at once


def remixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Hashes for a further word of the fingerprint: multiplied and folded; word 0 as given."""
    if word:
        hashes = hashes ^ np.uint64(word * 0x9E3779B97F4A7C15 & _MASK)
        hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        hashes = hashes ^ (hashes >> np.uint64(31))
    return hashes


def shingle_hashes(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Hashes of the runs of ``shingle`` words; a text of fewer words is one, if it has any."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, "<u8")
    joined = b" ".join(words)
    if len(words) <= shingle:
        spans = [(0, len(joined))]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lengths)
        starts = (ends - lengths)[: len(words) - shingle + 1]
        spans = zip(starts.tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in spans], dtype="<u8")


def simhash(text: bytes, shingle: int = SHINGLE, checks: int = 0, seed: int = SEED) -> list[int]:
    """Bits set in over half the hashes of the word shingles, as signed numbers.

    The first is the fingerprint; ``checks`` more follow, of the hashes mixed anew.
    """
    hashes = shingle_hashes(text, shingle, seed)
    if not len(hashes):
        return [0] * (1 + checks)
    found = []
    for word in range(1 + checks):
        ones = np.zeros(64, np.int64)
        for start in range(0, len(hashes), _CHUNK):
            part = remixed(hashes[start : start + _CHUNK], word)
            ones += np.unpackbits(
                part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
            ).sum(axis=0, dtype=np.int64)
        bits = np.packbits(2 * ones > len(hashes), bitorder="little")
        found.append(int(bits.view("<i8")[0]))
    return found


def fingerprints(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    checks: int = 0,
    *extra: str,
) -> DataFrame:
    """``doc_id, text_hash, fingerprint, check`` of every row; a null text is an empty one.

    ``check`` is an array of ``checks`` further words of the fingerprint.  Whole numbers
    named ``extra`` are handed on.
    """
    schema = "doc_id long, text_hash long, fingerprint long, check array<long>"
    schema += "".join(f", {name} long" for name in extra)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            found = [simhash(t.as_py(), shingle, checks) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([x[0] for x in found], pa.int64()),
                    pa.array([x[1:] for x in found], pa.list_(pa.int64())),
                    *(batch.column(3 + i) for i in range(len(extra))),
                ],
                ["doc_id", "text_hash", "fingerprint", "check", *extra],
            )

    rows = docs.select(
        F.col(quoted(id_column)).cast("long").alias("doc_id"),
        text_key(text_column).alias("text_hash"),
        text_or_empty(text_column).cast("binary").alias("text"),
        *extra,
    )
    return rows.mapInArrow(run, schema)


def block_masks(bits: int = BITS, blocks: int = BLOCKS) -> list[int]:
    """A mask for each choice of ``blocks - bits`` blocks, as signed numbers."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    single = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(single, blocks - bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def distance(a: np.ndarray, b: np.ndarray | np.int64) -> np.ndarray:
    """Differing bits; counted unsigned, as numpy counts those of absolute values."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def linked(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Which rows of fingerprint and check differ in ``most`` bits or fewer."""
    return distance(a, b).sum(axis=-1, dtype=np.int64) <= most


def forest(prints: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among rows of fingerprint and check."""
    names = prints[:, 0]
    edges, left = [], np.arange(len(prints))
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            node = frontier.pop()
            near = linked(prints[left], prints[node], most)
            if near.any():
                found = left[near]
                edges += [(int(names[node]), x) for x in names[found].tolist()]
                frontier += list(found)
                left = left[~near]
    return edges


def group_edges(prints: np.ndarray, sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Edges that connect what is linked in each of the groups that stand in a row.

    Narrow groups are compared all at once, first with the next row, then with the
    one after it, and so on.  Those with more links than rows, and wide groups, give
    a spanning forest.
    """
    group = np.repeat(np.arange(len(sizes)), sizes)
    at = np.flatnonzero((group[1:] == group[:-1]) & (sizes[group[1:]] <= _NARROW))
    shift, left, right = 1, [], []
    while len(at):
        near = at[linked(prints[at], prints[at + shift], most)]
        left.append(near)
        right.append(near + shift)
        shift += 1
        at = at[at + shift < len(group)]
        at = at[group[at + shift] == group[at]]
    u = np.concatenate([*left, np.empty(0, np.int64)]).astype(np.int64)
    v = np.concatenate([*right, np.empty(0, np.int64)]).astype(np.int64)
    many = (np.bincount(group[u], minlength=len(sizes)) > sizes) | (sizes > _NARROW)
    few = ~many[group[u]]
    names = prints[:, 0]
    edges = list(zip(names[u[few]].tolist(), names[v[few]].tolist(), strict=True))
    ends = np.cumsum(sizes)
    for end, size in zip(ends[many], sizes[many], strict=True):
        edges += forest(prints[end - size : end], most)
    return edges


def _links(most: int, checks: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; a group that runs on is carried to the next batch."""
        kept = np.empty((0, 3 + checks), np.int64)  # key, piece, fingerprint, check

        def changes(rows: np.ndarray) -> np.ndarray:
            return np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1

        def of(rows: np.ndarray) -> pa.RecordBatch:
            bounds = np.concatenate([[0], changes(rows), [len(rows)]])
            found = group_edges(rows[:, 2:], np.diff(bounds), most)
            u, v = zip(*found, strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"]
            )

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            check = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            check = check.reshape(batch.num_rows, checks)
            kept = np.concatenate([kept, np.column_stack([*new, check])])
            found = changes(kept)
            if len(found):
                yield of(kept[: found[-1]])
                kept = kept[found[-1] :]
        if len(kept):
            yield of(kept)

    return run


def links(
    prints: DataFrame,
    bits: int = BITS,
    blocks: int = BLOCKS,
    checks: int = 0,
    most: int | None = None,
    piece: int = PIECE,
) -> DataFrame:
    """Edges ``u, v`` that connect just what is linked.

    ``prints`` has different values of ``fingerprint``, each with a ``check`` of
    ``checks`` words.  Linked are those that share a key and differ in ``most`` bits or
    fewer over fingerprint and check together (``bits`` if not given).  Fingerprints
    within ``bits`` always share a key, others the less often the further apart.  More
    blocks make fuller keys, so fewer strangers meet, and more rows: choose them for
    the number of fingerprints.  A crowded key is cut into pieces of about ``piece``;
    each pair of pieces is a group of its own.
    """
    masks = block_masks(bits, blocks)
    # A choice and its blocks as one hash: what collides is told apart by distance.
    chosen = (
        F.xxhash64(F.col("fingerprint").bitwiseAND(F.lit(m)), F.lit(i))
        for i, m in enumerate(masks)
    )
    keys = stored(
        prints.select(F.explode(F.array(*chosen)).alias("key"), "fingerprint", "check"), "blocks"
    )
    crowded = (
        keys.groupBy("key")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > piece)
        .select("key", F.ceil(F.col("n") / piece).cast("long").alias("pieces"))
    )
    crowded = stored(crowded, "crowded")
    own = F.pmod(F.xxhash64("fingerprint", F.lit("piece")), F.col("pieces"))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1),
        lambda other: F.least(own, other) * F.col("pieces") + F.greatest(own, other),
    )
    alone = F.array(F.lit(0).cast("long"))
    grouped = keys.join(crowded, "key", "left").select(
        "key",
        F.explode(F.when(F.col("pieces").isNull(), alone).otherwise(pairs)).alias("piece"),
        "fingerprint",
        "check",
    )
    return (
        grouped.repartition("key", "piece")
        .sortWithinPartitions("key", "piece", "fingerprint")
        .mapInArrow(_links(bits if most is None else most, checks), "u long, v long")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    bits: int = BITS,
    blocks: int = BLOCKS,
    checks: int = 0,
    most: int | None = None,
) -> DataFrame:
    """Each row's fingerprint and the first row it is linked to, over any number of links.

    Returns ``doc_id, text_hash, fingerprint, first`` with ``first`` a struct of the
    smallest ``doc_id`` (nulls last) and ``text_hash`` of the component.  Texts
    without words have fingerprint zero and are linked like any other.  For ``checks``
    and ``most`` see :func:`links`.
    """
    prints = stored(
        fingerprints(docs, id_column, text_column, shingle, checks), "fingerprints"
    )
    row = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "text_hash")
    nodes = prints.groupBy("fingerprint").agg(
        F.min(row).alias("first"), F.min("check").alias("check")
    )
    roots = components(links(nodes.select("fingerprint", "check"), bits, blocks, checks, most))
    placed = nodes.join(
        roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).select("fingerprint", F.coalesce("root", "fingerprint").alias("root"), "first")
    placed = stored(placed, "placed")
    first = placed.groupBy("root").agg(F.min("first").alias("first"))
    return prints.join(
        placed.select("fingerprint", "root").join(first, "root").drop("root"), "fingerprint"
    ).select("doc_id", "text_hash", "fingerprint", "first")


def clusters(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` in hexadecimal, ``component_id``.

    Null and empty texts have fingerprint zero; very long ones are hashed whole, in pieces; a
    repeated row has the same result each time.  A component is named by its smallest id, null
    only if it has no other.  An empty table gives no row; columns other than ``doc_id, text``
    are ignored, whatever their names.
    """
    return near_duplicates(docs).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
    )


def one_of_each(
    docs: DataFrame,
    shingle: int = SHINGLE,
    bits: int = BITS,
    blocks: int = BLOCKS,
    checks: int = 0,
    most: int | None = None,
) -> DataFrame:
    """The first document of each component of :func:`near_duplicates`, with all its columns.

    Of repeated rows and of ties in ``doc_id`` and text one row stays.  Texts without words
    are one component; an empty table gives an empty one.
    """
    rows = docs.select(F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row"))
    rows = rows.select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        text_key(F.col("row.text")).alias("text_hash"),
        "row",
    )
    found = near_duplicates(
        docs, shingle=shingle, bits=bits, blocks=blocks, checks=checks, most=most
    )
    kept = (
        found.where(
            F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
            & (F.col("text_hash") == F.col("first.text_hash"))
        )
        .select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
        .distinct()
    )
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (
        F.col("text_hash") == F.col("kept_hash")
    )
    return (
        rows.join(kept, same, "left_semi")
        .dropDuplicates(["doc_id", "text_hash"])
        .select(*(F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns))
    )

"""Spelling variants: words one edit apart, found over a relational trie.

The words' trie is a table of edges (parent, letter, node).  A state is a pair of nodes that
one edit sets apart: what some words begin with, up to a position, and a node that other
words have there.  States start where a node branches (a letter replaced, or one more) and
are joined with the edges again and again, both sides taking the same letter, a level at a
time.  Two nodes that end words are neighbours; once one side holds a single word the other
word is known whole and looked up.  Words share their states as long as they share their
beginning, so a common beginning is searched once and not once a word.

Words over ``LONG`` letters would take a level for each letter.  They are joined on hashes
of themselves with any one letter left out, and compared.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.llm.common import ascii_lower, quoted, slices, stored, text_or_empty

RUN = "[a-zÀ-ÿ]+"  # after A-Z are lowered
MIN_LETTERS, MIN_COUNT, ONE_IN, RATIO, LONG = 5, 3, 97, 2, 48
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def words(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: the words of enough letters and occurrences in all texts.

    A run of letters loses one if the number of its document and itself says so.
    """
    runs = docs.select(
        F.coalesce(F.col(quoted("doc_id")).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(ascii_lower(text_or_empty("text")), F.lit(RUN), F.lit(0))).alias("run"),
    )
    hashed = runs.select(
        "run",
        F.length("run").alias("size"),
        F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"),
    ).where(F.col("size") >= min_letters)
    at = (F.col("h") % F.col("size")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    word = F.when(F.col("h") % ONE_IN == 0, cut).otherwise(F.col("run"))
    return (
        hashed.select(word.alias("word"))
        .where(F.length("word") >= min_letters)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_count)
    )


def trie(words: DataFrame) -> DataFrame:
    """``parent, letter, node, n, word, ends`` of each edge of the trie of all words.

    ``n`` is the number of words below the edge's node, ``word`` the smallest, ``ends``
    whether the node is a word.  Below a node of one word there are no edges.
    """
    nodes = (
        words.select("word", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("depth"))
        .select(F.substring("word", F.lit(1), F.col("depth")).alias("node"), "word")
        .groupBy("node")
        .agg(
            F.count("*").alias("n"),
            F.min("word").alias("word"),
            F.max(F.col("word") == F.col("node")).alias("ends"),
        )
    )
    nodes = stored(nodes, "nodes")
    split = nodes.where("n > 1").select(F.col("node").alias("parent"))
    below = nodes.where("node != ''").select(
        F.expr("substring(node, 1, length(node) - 1)").alias("parent"),
        F.expr("right(node, 1)").alias("letter"),
        "node", "n", "word", "ends",
    )
    return below.join(split, "parent", "left_semi")


def _side(name: str) -> list:
    """The columns of an edge's node for one side of a state."""
    return [F.col(c).alias(f"{name}_{c}") for c in ("node", "n", "word", "ends")]


def starts(edges: DataFrame) -> DataFrame:
    """States right after the edit: two letters of a node, or one more on one side."""
    one = edges.select("parent", *_side("u"))
    other = edges.select("parent", *_side("v"))
    # The letters of a node meet each other: as many as the alphabet has, not the words.
    replaced = one.join(other, "parent").where("u_node < v_node").drop("parent")
    node = edges.select(*_side("v"))
    root = edges.where("parent = ''").agg(
        F.lit("").alias("v_node"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("v_n"),
        F.min("word").alias("v_word"),
        F.lit(False).alias("v_ends"),
    )
    longer = one.join(node.unionByName(root), F.col("parent") == F.col("v_node")).drop("parent")
    return replaced.unionByName(longer)


def advanced(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States a letter on, the same on both sides."""
    both = states.where("u_n > 1 AND v_n > 1").select("u_node", "v_node")
    one = edges.select(F.col("parent").alias("u_node"), "letter", *(c.alias(f"to_{i}") for i, c in enumerate(_side("u"))))
    step = both.join(one, "u_node").select(
        F.concat("v_node", "letter").alias("v_node"),
        *(F.col(f"to_{i}").alias(f"u_{c}") for i, c in enumerate(("node", "n", "word", "ends"))),
    )
    return step.join(edges.select(*_side("v")), "v_node")


def met(states: DataFrame) -> DataFrame:
    """``a, b``: words that end together, and a word with the text its neighbour must be."""
    rest = "concat({0}_node, substring({1}_word, length({1}_node) + 1))"
    pair = (
        F.when(F.col("u_ends") & F.col("v_ends"), F.array(F.struct(F.col("u_node").alias("a"), F.col("v_node").alias("b"))))
        .otherwise(F.array().cast("array<struct<a: string, b: string>>"))
    )
    known = F.when(
        F.col("u_n") == 1, F.struct(F.col("u_word").alias("a"), F.expr(rest.format("v", "u")).alias("b"))
    ).when(F.col("v_n") == 1, F.struct(F.col("v_word").alias("a"), F.expr(rest.format("u", "v")).alias("b")))
    every = F.array_append(pair, known)
    return states.select(F.explode(F.array_compact(every)).alias("p")).select("p.*")


def trie_pairs(words: DataFrame) -> DataFrame:
    """``a, b`` of words one edit apart, each pair at least once; some ``b`` may be no word."""
    edges = stored(trie(words), "trie")
    states = stored(starts(edges), "states")
    found = met(states)
    while not states.isEmpty():
        states = stored(advanced(states, edges), "states")
        found = found.unionByName(met(states))
    return found


def without_a_letter(word: str) -> np.ndarray:
    """Hashes of a word with one letter left out, without repeats; the whole word's is first."""
    codes = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(codes), _BASE, np.uint64)) * np.uint64(_UNBASE)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers, dtype=np.uint64)])
        left = sums[:-1] + (sums[-1] - sums[1:]) * np.uint64(_UNBASE)
    return np.concatenate([sums[-1:], np.unique(left)]).view(np.int64)


def long_pairs(words: DataFrame) -> DataFrame:
    """``a, b`` of the given words that are one edit apart."""
    numbered = stored(words.select("word").withColumn("number", F.monotonically_increasing_id()), "long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            word, number = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            keys = without_a_letter(word)
            for start in range(0, len(keys), 100_000):
                part = keys[start : start + 100_000]
                size = np.full(len(part), len(word) - 1)
                size[0] += start == 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array(size), pa.array(np.full(len(part), number))],
                    ["key", "size", "number"],
                )

    keys = stored(numbered.mapInArrow(run, "key long, size long, number long"), "long-keys")
    pairs = (
        keys.withColumnRenamed("number", "x")
        .join(keys.withColumnRenamed("number", "y"), ["key", "size"])
        .where("x < y")
        .select("x", "y")
        .distinct()
    )
    return (
        pairs.join(numbered.select(F.col("number").alias("x"), F.col("word").alias("a")), "x")
        .join(numbered.select(F.col("number").alias("y"), F.col("word").alias("b")), "y")
        .where(F.levenshtein("a", "b", 1) == 1)
        .select("a", "b")
    )


def neighbours(words: DataFrame, long: int = LONG) -> DataFrame:
    """``word, near`` for each ordered pair of words that one edit sets apart."""
    size = F.length("word")
    pairs = trie_pairs(words.where(size <= long)).join(
        words.select(F.col("word").alias("b")), "b", "left_semi"
    )
    # A word of just ``long`` letters may be near a longer one.
    beyond = words.where(size >= long)
    if not beyond.where(size > long).isEmpty():
        pairs = pairs.select("a", "b").unionByName(long_pairs(beyond))
    once = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    once = stored(once, "neighbours")
    return once.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(
        once.select(F.col("b").alias("word"), F.col("a").alias("near"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the last form reached; each round doubles the steps."""
    now = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = stored(
            now.join(on, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "roots",
        )
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(
    docs: DataFrame,
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    long: int = LONG,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word.

    A word's form is its near word of most occurrences, of equal ones the smallest, if that
    has ``ratio`` times its own or more; ``root`` follows forms to the last.  Occurrences
    are counted over all rows, a repeated row as often as it stands there; a null id is an
    empty one in the number of a run.  Null, empty and letterless texts have no words, very
    long texts and words are taken whole, an empty table gives no row.  Columns other than
    id and text are ignored, whatever their names.
    """
    known = stored(words(docs, min_letters, min_count), "words")
    other = known.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    first = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near")))
    near = (
        neighbours(known, long)
        .join(other, "near")
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), first.alias("first"))
    )
    taken = -F.col("first.order") >= ratio * F.col("n")
    judged = stored(
        known.join(near, "word", "left").select(
            "word",
            F.when(taken, F.col("first.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(taken, -F.col("first.order")).alias("form_n"),
        ),
        "judged",
    )
    last = roots(judged.where("form IS NOT NULL"))
    return judged.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

"""Personal data: fixed formats, and bootstrapped contextual extraction.

What the formats find are seeds.  The words around seeds are lexical patterns; a
pattern is trusted by the share of known instances among the different instances it
surrounds, an unknown instance by the patterns around it.  Both are scored in turn
over the graph of patterns and instances in Spark; instances of trusted patterns
become known.  All places of what is known are reported, also those of a seed's value
that the formats pass over, as in a longer run of digits.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymart.llm.common import quoted, slices, stored, text_key, text_or_empty

KINDS = ("email", "ip", "card", "phone")
MIN_SEEDS, MIN_PATTERN, MIN_INSTANCE, LONG_WORD = 5, 0.8, 0.9, 64

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^ \t-\r]+")
_CANDIDATE = re.compile(r"[^ \t-\r]*[0-9@][^ \t-\r]*")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: the run of local characters before each ``@`` and its domain.

    Found from the ``@`` backwards, so that long words cost one look each.
    """
    end = 0
    for m in _AT.finditer(text):
        start = m.start()
        floor = end
        while start > floor and _is_local(text[start - 1]):
            start -= 1
        if start < m.start():
            yield start, m.end()
            end = m.end()


_LOCALS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_is_local = _LOCALS.__contains__


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind number, end`` of all fixed-format spans in order."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGITS.findall(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def shape_kinds(value: str) -> list[int]:
    """The kinds an unknown token may be, by its characters alone."""
    digits = len(_DIGITS.findall(value))
    kinds = []
    if "@" in value.strip("@"):
        kinds.append(0)
    if digits >= 4 and value.count(".") + value.count(":") >= 3:
        kinds.append(1)
    if 12 <= digits <= 19 and digits * 10 >= len(value) * 7:
        kinds.append(2)
    if 7 <= digits <= 15 and digits * 10 >= len(value) * 6:
        kinds.append(3)
    return kinds


def _masked(word: str) -> str:
    """A context word: lower case, digits alike, outer punctuation away; a long one as a hash."""
    word = re.sub(r"[0-9]", "0", word.lower().strip("\"'.,;:!?()[]{}<>"))
    if len(word) <= LONG_WORD:
        return word
    return "#" + hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


class _Context:
    """The words around places that come in order of their start; each word is cut out once."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts, self.ends = [], []
        for m in _TOKEN.finditer(text):
            self.starts.append(m.start())
            self.ends.append(m.end())
        self.words: dict[int, str] = {}
        self.last = 0  # end of the place before

    def word(self, i: int) -> str | None:
        """The i-th word, None outside the text."""
        if not 0 <= i < len(self.starts):
            return None
        if i not in self.words:
            self.words[i] = _masked(self.text[self.starts[i] : self.ends[i]])
        return self.words[i]

    def around(self, a: int, b: int) -> tuple[list[str], str | None]:
        """Up to two words before ``a`` and the one after ``b``.

        What stands before ``a`` in its own word counts as one, but for what belongs to an
        earlier place; a word that goes on after ``b`` is passed over.
        """
        first = bisect_right(self.starts, a) - 1
        before = [self.word(first - 2), self.word(first - 1)]
        own = self.text[max(self.starts[first], min(self.last, a)) : a]
        if own:
            before = [before[1], _masked(own)]
        self.last = max(self.last, b)
        return [w for w in before if w is not None], self.word(bisect_left(self.starts, b))


def instances(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds and identifier-like tokens with the patterns around them.

    A pattern is the two words before, or the one before and the one after.
    """
    if not spans and not _DIGITS.search(text) and "@" not in text:
        return []
    found = [(a, b, [k], True) for a, k, b in spans]
    taken = sorted((a, b) for a, _, b in spans)
    i = 0
    for m in _CANDIDATE.finditer(text):
        a, b = m.start(), m.end()
        while a < b and text[a] in "\"'(<[{,;:":
            a += 1
        while b > a and text[b - 1] in "\"'.,;:!?)]}>":
            b -= 1
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if i < len(taken) and taken[i][0] < b:
            continue
        kinds = shape_kinds(text[a:b])
        if kinds:
            found.append((a, b, kinds, False))
    result, context = [], _Context(text)
    for a, b, kinds, seed in sorted(found, key=lambda f: f[:3]):
        before, after = context.around(a, b)
        left = ["^"] * (2 - len(before)) + before
        patterns = [f"{left[0]} {left[1]} _", f"{left[1]} _ {'$' if after is None else after}"]
        value = hashlib.blake2b(text[a:b].encode("utf-8", "surrogatepass"), digest_size=8)
        for kind in kinds:
            result.append(
                {
                    "start": a,
                    "end": b,
                    "kind": kind,
                    "seed": seed,
                    "value": int.from_bytes(value.digest(), signed=True),
                    "patterns": patterns,
                }
            )
    return result


_INSTANCE = pa.struct(
    [
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("kind", pa.int32()),
        ("seed", pa.bool_()),
        ("value", pa.int64()),
        ("patterns", pa.list_(pa.string())),
    ]
)


def extracted(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, found`` with the instances of every row's whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            found = [instances(t, base_spans(t)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(_INSTANCE))],
                ["doc_id", "text_hash", "found"],
            )

    rows = docs.select(
        F.col(quoted("doc_id")).cast("long").alias("doc_id"),
        text_key("text").alias("text_hash"),
        text_or_empty("text").alias("text"),
    )
    return rows.mapInArrow(
        run,
        "doc_id long, text_hash long, found array<struct<start: long, end: long, kind: int, "
        "seed: boolean, value: long, patterns: array<string>>>",
    )


def bootstrap(
    found: DataFrame,
    min_seeds: int = MIN_SEEDS,
    min_pattern: float = MIN_PATTERN,
    min_instance: float = MIN_INSTANCE,
) -> DataFrame:
    """``kind, value`` of the seeds and of the instances that trusted patterns discover.

    ``found`` has ``kind, value, seed, pattern`` for each pattern around an instance.
    A pattern counts for a kind if it surrounds ``min_seeds`` or more known values and
    their weight is ``min_pattern`` or more of its values of that shape.  An unknown
    value is known from a combined score (noisy-or) of ``min_instance`` on.
    """
    graph = stored(
        found.groupBy("kind", "value", F.xxhash64("pattern").alias("pattern")).agg(
            F.max("seed").alias("seed")
        ),
        "graph",
    )
    if graph.where("NOT seed").isEmpty():
        return graph.select("kind", "value").limit(0)
    known = graph.where("seed").select("kind", "value").distinct()
    known = stored(known.withColumn("score", F.lit(1.0)), "known")
    n_known = known.count()
    while True:  # known values only grow, so this ends when none is added
        scored = graph.join(known, ["kind", "value"], "left")
        patterns = (
            scored.groupBy("kind", "pattern")
            .agg(
                F.count("score").alias("support"),
                (F.sum(F.coalesce("score", F.lit(0.0))) / F.count("*")).alias("trust"),
            )
            .where((F.col("support") >= min_seeds) & (F.col("trust") >= min_pattern))
        )
        doubt = F.sum(F.log(1 - F.least("trust", F.lit(0.999))))
        new = (
            scored.where("score IS NULL")
            .join(patterns, ["kind", "pattern"])
            .groupBy("kind", "value")
            .agg((1 - F.exp(doubt)).alias("score"))
            .where(F.col("score") >= min_instance)
        )
        known = stored(known.unionByName(new), "known")
        n = known.count()
        if n == n_known:
            return known.select("kind", "value")
        n_known = n


def _spans(array: Column, names: Column) -> Column:
    return F.array_join(
        F.transform(
            F.array_sort(F.transform(array, lambda x: F.struct(x["start"], x["kind"], x["end"]))),
            lambda x: F.concat_ws(
                ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string")
            ),
        ),
        ",",
    )


def scan(docs: DataFrame) -> DataFrame:
    """Counts of fixed-format spans, their hash, and all spans of every row.

    Places are code points, the end exclusive.  A null text is an empty one and has
    no spans; a very long one is searched whole, its long words stand as hashes in patterns;
    a repeated row has the same result each time.  Where two discovered kinds name the same
    place, the first as listed stays.  An empty table gives no row; columns other than
    ``doc_id, text`` are ignored, whatever their names.
    """
    found = stored(extracted(docs), "instances")
    flat = found.select("doc_id", "text_hash", F.explode("found").alias("i")).select(
        "doc_id", "text_hash", "i.*"
    )
    discovered = stored(
        bootstrap(flat.select("kind", "value", "seed", F.explode("patterns").alias("pattern"))),
        "discovered",
    )
    more = (
        flat.where("NOT seed")
        .join(discovered, ["kind", "value"], "left_semi")
        .groupBy("doc_id", "text_hash", "start", "end")
        .agg(F.min("kind").alias("kind"))
        .groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
        .agg(F.collect_list(F.struct("start", "end", "kind")).alias("more"))
    )
    names = F.array(*map(F.lit, KINDS))
    seeds = F.filter("found", lambda x: x["seed"])
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    rows = found.select(
        "doc_id",
        "text_hash",
        F.transform(
            seeds, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))
        ).alias("base"),
    )
    every = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more"))

    def count(k: int):
        return F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return rows.join(more, same, "left").select(
        "doc_id",
        *map(count, range(len(KINDS))),
        F.sha2(_spans(F.col("base"), names), 256).alias("base_sha256"),
        _spans(every, names).alias("spans"),
    )

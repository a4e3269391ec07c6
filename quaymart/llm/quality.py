"""Quality rules: a table of thresholds compiled into one projection.

Every feature and every rule is a built-in expression over the text of a row, so
documents are judged in the scan that reads them, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymart.llm.common import WORD, quoted, text_or_empty, where_computed, word_array

SYMBOLS = "#*$%&|<>"

# Frequent function words of the four languages, as they are written
# inside and at the start of a sentence.
_STOP = {
    "en": "the of and to a in is that for it was on with as be are by this from or an",
    "de": "der die das und in den von zu mit sich des auf ist im dem nicht ein eine",
    "fr": "le la les de des et en un une du que est pour dans qui par sur au avec",
    "es": "el la los las de que y en un una del se por con para es no su al lo",
}
STOP_WORDS = sorted(
    {form for words in _STOP.values() for w in words.split() for form in (w, w.title())}
)


@dataclass(frozen=True)
class Rule:
    """A document fails if ``scale * feature`` leaves ``low .. high`` times ``base``.

    All values are whole numbers, so that no rounding decides.
    """

    feature: str
    base: str
    scale: int
    low: int | None = None
    high: int | None = None


#: A document of fewer words, or in larger part made of repeated windows, fails.
BASE_RULES = (
    Rule("n_words", "one", 1, low=50),
    Rule("n_repeat_words", "n_words", 100, high=50),
)
#: Length of words, symbols, shouting, function words, repeated and listed lines.
METHOD_RULES = (
    Rule("word_chars", "n_words", 10, low=20, high=150),
    Rule("n_symbols", "n_words", 100, high=30),
    Rule("n_exclamations", "n_words", 100, high=50),
    Rule("n_stop_words", "n_words", 100, low=1),
    Rule("n_dup_lines", "n_lines", 100, high=50),
    Rule("n_bullet_lines", "n_lines", 100, high=90),
    Rule("n_ellipsis_lines", "n_lines", 100, high=50),
)
FEATURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_exclamations",
    "n_stop_words",
    "n_lines",
    "n_bullet_lines",
    "n_ellipsis_lines",
)


def _count_if(array: Column, condition) -> Column:
    return F.size(F.filter(array, condition))


def _let(value: Column, body) -> Column:
    """``body`` over a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _windows(words: Column) -> Column:
    """All 3-word windows with their position, sorted: equal ones are neighbours."""
    n = F.size(words)
    padded = F.arrays_zip(
        words.alias("a"),
        F.slice(words, 2, n).alias("b"),
        F.slice(words, 3, n).alias("c"),
        F.sequence(F.lit(0), n).alias("p"),
    )
    return F.sort_array(F.slice(padded, 1, F.greatest(n - 2, F.lit(0))))


def _repeated(windows: Column) -> Column:
    """Positions of windows that equal a neighbour, in order, some of them twice."""
    pairs = F.zip_with(
        windows,
        F.slice(windows, 2, F.size(windows)),
        lambda x, y: F.when(
            (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]),
            F.array(x["p"], y["p"]),
        ),
    )
    return F.sort_array(F.flatten(F.filter(pairs, lambda x: x.isNotNull())))


def _covered(positions: Column) -> Column:
    """Words inside the windows at these positions: each adds those up to the next."""
    steps = F.zip_with(
        positions,
        F.slice(positions, 2, F.size(positions)),
        lambda x, y: F.coalesce(F.least(y - x, F.lit(3)), F.lit(3)),
    )
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def _features(
    text: Column, words: Column, lines: Column, repeated: Column
) -> dict[str, Column]:
    shown = F.filter(lines, lambda x: x.rlike(WORD))
    lengths = F.transform(words, F.length)
    features = {
        "n_words": F.size(words),
        "word_chars": F.aggregate(lengths, F.lit(0), lambda total, n: total + n),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")),
        "n_dup_lines": _let(shown, lambda s: F.size(s) - F.size(F.array_distinct(s))),
        "n_repeat_words": _covered(repeated),
        "n_exclamations": F.regexp_count(text, F.lit("!")),
        "n_stop_words": _count_if(words, lambda w: w.isin(STOP_WORDS)),
        "n_lines": F.size(shown),
        "n_bullet_lines": _count_if(lines, lambda x: x.rlike(r"^[ \t]*[-*•·]")),
        "n_ellipsis_lines": _count_if(
            lines, lambda x: x.rlike(r"(\.\.\.|…)[ \t\r]*$")
        ),
    }
    return {name: column.cast("long") for name, column in features.items()}


def _fails(rules: Sequence[Rule]) -> Column:
    failed = F.lit(False)
    for rule in rules:
        value = F.col(rule.feature) * rule.scale
        base = F.lit(1) if rule.base == "one" else F.col(rule.base)
        if rule.low is not None:
            failed = failed | (value < base * rule.low)
        if rule.high is not None:
            failed = failed | (value > base * rule.high)
    return failed


def quality(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rules: Sequence[Rule] = METHOD_RULES,
) -> DataFrame:
    """Features and verdict of every row: id, :data:`FEATURES`, ``base_failed``, ``kept``.

    A null text is an empty one and fails; a very long one is judged whole; other columns
    are not looked at, whatever their names; a repeated row gives a repeated result, and an
    empty table none.  A value at a rule's limit passes.
    """
    text = text_or_empty(text_column)
    # One step a projection: each value is computed once, and the sort is compiled.
    steps = (
        docs.select(F.col(quoted(id_column)).alias("doc_id"), text.alias("text"))
        .withColumns({"words": word_array(F.col("text")), "lines": F.split("text", "\n")})
        .withColumn("windows", _windows(F.col("words")))
        .withColumn("repeated", _repeated(F.col("windows")))
    )
    parts = [F.col(c) for c in ("text", "words", "lines", "repeated")]
    features = steps.select(
        "doc_id", *(c.alias(name) for name, c in _features(*parts).items())
    )
    return features.withColumn("base_failed", _fails(BASE_RULES)).withColumn(
        "kept", ~(F.col("base_failed") | _fails(rules))
    )


def keep_good(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows that pass all rules, with all their columns unchanged."""
    row = F.struct(*(F.col(quoted(c)) for c in docs.columns))
    rows = docs.select(row.alias("row"), F.col(quoted(text_column)).alias("text"))
    judged = quality(rows, id_column="row")
    return where_computed(judged, F.col("kept")).select(
        *(F.col(f"doc_id.{quoted(c)}").alias(c) for c in docs.columns)
    )

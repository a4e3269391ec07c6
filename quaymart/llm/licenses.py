"""License scan: phrases, and an exact set-similarity join with license templates.

A text block is a line, or a window of lines that follow each other without a blank one,
long enough for the longest template wherever it begins in the first line; so a license
broken over lines is met too.  A block matches a template if it holds at least a threshold
share of the template's different words.  Words are ordered by how many blocks of
the whole corpus hold them, rarest first.  A block that matches must share a word
with the template's prefix (prefix filter), have words enough (length filter), and
have enough of them after the shared word in both (positional filter).  What passes
is verified by the exact count.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymart.llm.common import quoted, slices, stored, text_key, text_or_empty

THRESHOLD = 0.8
#: Bytes of license texts that are read as templates.
TEMPLATE_BYTES = 64 << 20
#: Bytes of the templates' words that may be broadcast.
BROADCAST_BYTES = 64 << 20
#: Phrases whose places are counted, and their labels.
PHRASES = {
    ("mit", "license"): "mit",
    ("apache", "license"): "apache",
    ("general", "public", "license"): "gpl",
}
# Short notices and characteristic sentences of common licenses.
TEMPLATES = {
    "apache-notice": ("apache", "Licensed under the Apache License, Version 2.0"),
    "apache-terms": (
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed "
        "under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied",
    ),
    "mit-notice": ("mit", "Released under the MIT License"),
    "mit-grant": (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of "
        "this software and associated documentation files, to deal in the Software "
        "without restriction",
    ),
    "gpl-notice": (
        "gpl",
        "This work is licensed under the GNU General Public License, version 3",
    ),
    "gpl-terms": (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under "
        "the terms of the GNU General Public License as published by the Free Software "
        "Foundation",
    ),
    "cc-by-nc-notice": ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    "cc-by-notice": (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "bsd-terms": (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, "
        "are permitted provided that the following conditions are met",
    ),
    "mpl-notice": (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
}
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words(text: str) -> list[str]:
    """Words with A-Z in lower case: letters, digits and all beyond ASCII."""
    return _WORD.findall(text.translate(_LOWER) if not text.isascii() else text.lower())


def phrase_places(tokens: list[str]) -> list[tuple[int, str]]:
    """Start and label of every place where a phrase's words stand consecutively."""
    found = []
    ends = {phrase[-1] for phrase in PHRASES}
    for end in ends:
        at = -1
        try:
            while True:
                at = tokens.index(end, at + 1)
                for phrase, label in PHRASES.items():
                    start = at - len(phrase) + 1
                    if start >= 0 and tuple(tokens[start : at + 1]) == phrase:
                        found.append((start, label))
        except ValueError:
            continue
    return sorted(found)


def template_words(templates: Mapping[str, tuple[str, str]]) -> dict[str, list[str]]:
    return {name: sorted(set(words(text))) for name, (_, text) in templates.items()}


def _needed(size: int, threshold: float) -> int:
    """The smallest count that is at least the threshold share of ``size``."""
    return max(1, math.ceil(round(threshold * size, 9)))


def windows(
    lines: list[tuple[int, set[str], set[int]]], longest: int, least: int
) -> list[dict]:
    """Blocks of two or more lines, given by word count, words and numbers of known words.

    From each line on as many as hold any ``longest`` words in a row that begin in it;
    what lies within the window before is left out.
    """
    blocks, end, total = [], 0, 0  # words of the lines between a first one and the end
    for first in range(len(lines) - 1):
        if end <= first:
            end, total = first + 1, 0
        else:
            total -= lines[first][0] if first else 0
        before = end
        while end < len(lines) and total < longest - 1:
            total += lines[end][0]
            end += 1
        if first and end == before or end - first < 2:
            continue
        known = set().union(*(x[2] for x in lines[first:end]))
        if known and len(known) >= least:
            size = len(set().union(*(x[1] for x in lines[first:end])))
            blocks.append({"words": list(known), "size": size})
    return blocks


_SCANNED = (
    "doc_id long, text_hash long, n_words long, n_base long, first_word long, last_word long, "
    "base array<string>, blocks array<struct<words: array<int>, size: int>>, "
    "counts map<int, long>"
)


def scanned(
    docs: DataFrame, templates: Mapping[str, tuple[str, str]], threshold: float
) -> DataFrame:
    """One pass over the texts: phrases, blocks that may match, and word counts.

    Of a block only the words that occur in templates matter, and only blocks with
    as many of them as the smallest template needs are handed on.  Rows that carry
    ``counts`` (blocks that hold a word, over all blocks) belong to no document.
    """
    sets = template_words(templates)
    number = {w: i for i, w in enumerate(sorted({w for s in sets.values() for w in s}))}
    least = min((_needed(len(s), threshold) for s in sets.values()), default=0)
    longest = max((len(words(text)) for _, text in templates.values()), default=0)
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_hash", pa.int64()),
            ("n_words", pa.int64()),
            ("n_base", pa.int64()),
            ("first_word", pa.int64()),
            ("last_word", pa.int64()),
            ("base", pa.list_(pa.string())),
            ("blocks", pa.list_(pa.struct([("words", pa.list_(pa.int32())), ("size", pa.int32())]))),
            ("counts", pa.map_(pa.int32(), pa.int64())),
        ]
    )

    def scan(doc_id: int | None, key: int, text: str, counts: Counter) -> tuple:
        total, places, blocks = 0, [], []
        carried: list[str] = []  # phrases may run over a line break
        paragraph: list[tuple[int, set[str], set[int]]] = []
        for line in text.split("\n"):
            tokens = words(line)
            if not tokens:
                if not line.strip():
                    blocks += windows(paragraph, longest, least)
                    paragraph = []
                continue
            found = phrase_places(carried + tokens)
            places += [
                (total - len(carried) + at, label)
                for at, label in found
                if at + _size(label) > len(carried)
            ]
            total += len(tokens)
            carried = (carried + tokens)[-(_LONGEST - 1) :]
            distinct = set(tokens)
            known = [number[w] for w in distinct if w in number]
            counts.update(known)
            if number and len(known) >= least:
                blocks.append({"words": known, "size": len(distinct)})
            paragraph.append((len(tokens), distinct, set(known)))
        blocks += windows(paragraph, longest, least)
        starts = [at for at, _ in places]
        labels = sorted({label for _, label in places})
        return (
            doc_id,
            key,
            total,
            len(places),
            min(starts, default=None),
            max(starts, default=None),
            labels,
            blocks,
            None,
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in slices(batches, 500):
            columns = [batch.column(i).to_pylist() for i in range(3)]
            yield out([scan(*row, counts) for row in zip(*columns, strict=True)])
        if counts:
            yield out([(None,) * 8 + (list(counts.items()),)])

    rows = docs.select(
        F.col(quoted("doc_id")).cast("long").alias("doc_id"),
        text_key("text").alias("text_hash"),
        text_or_empty("text").alias("text"),
    )
    return rows.mapInArrow(run, _SCANNED)


_LONGEST = max(map(len, PHRASES))


def _size(label: str) -> int:
    return next(len(p) for p, own in PHRASES.items() if own == label)


def matches(
    blocks: DataFrame,
    counts: DataFrame,
    templates: Mapping[str, tuple[str, str]],
    threshold: float,
) -> DataFrame:
    """``block, template, containment`` of every pair that meets the threshold.

    ``blocks`` has ``block`` (any key), ``words`` (numbers of template words) and
    ``size``; ``counts`` the number of blocks by word.
    """
    spark = blocks.sparkSession
    sets = template_words(templates)
    vocabulary = sorted({w for s in sets.values() for w in s})
    # One row for each word of the templates.
    held = {r["word"]: r["n"] for r in counts.collect()}
    order = sorted(range(len(vocabulary)), key=lambda w: (held.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    number = {w: i for i, w in enumerate(vocabulary)}
    prefixes, whole = [], []
    for name, own in sets.items():
        ranked = sorted(rank[number[w]] for w in own)
        needed = _needed(len(ranked), threshold)
        whole.append((name, ranked))
        prefixes += [
            (name, len(ranked), needed, word, at)
            for at, word in enumerate(ranked[: len(ranked) - needed + 1])
        ]
    starts = spark.createDataFrame(
        prefixes, "template string, template_size int, needed int, word int, template_at int"
    )
    contents = spark.createDataFrame(whole, "template string, template_words array<int>")
    if 40 * len(prefixes) + 8 * sum(map(len, sets.values())) <= BROADCAST_BYTES:
        starts, contents = F.broadcast(starts), F.broadcast(contents)
    # Looked up by word, so that the plan is the same for any number of templates.
    first = {r[3] for r in prefixes}
    by_word = spark.createDataFrame(
        [([rank[w] for w in range(len(order))], [r in first for r in range(len(order))])],
        "ranks array<int>, starting array<boolean>",
    )
    ordered = blocks.select(
        "block",
        "size",
        "words",
        by_word.select("ranks").scalar().alias("ranks"),
        by_word.select("starting").scalar().alias("starting"),
    ).withColumn("words", F.array_sort(F.transform("words", lambda w: F.get("ranks", w))))
    tokens = ordered.select(
        "*",
        F.explode(
            F.filter(
                F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
                lambda x: F.get("starting", x["word"]),
            )
        ).alias("token"),
    ).select("block", "words", "size", "token.word", "token.at")
    rest = F.least(
        F.col("template_size") - F.col("template_at"), F.size("words") - F.col("at")
    )
    shared = F.size(F.array_intersect("words", "template_words"))
    return (
        tokens.join(starts, "word")
        .where((F.col("size") >= F.col("needed")) & (rest >= F.col("needed")))
        .join(contents, "template")
        .where(shared >= F.col("needed"))
        .select("block", "template", (shared / F.col("template_size")).alias("containment"))
    )


def read_templates(spark: SparkSession, path: str, label: Callable[[str], str] = str) -> dict:
    """Templates from a folder of license texts, one a file, named by the file.

    ``label`` gives a template's label from its name, else the name is the label.  Texts
    without words are left out.  Beyond ``TEMPLATE_BYTES`` of texts the folder is refused.
    """
    files = spark.read.text(path, wholetext=True)
    size = files.agg(F.sum(F.octet_length("value"))).first()[0] or 0
    if size > TEMPLATE_BYTES:
        raise ValueError(f"{size} bytes of license texts, at most {TEMPLATE_BYTES}")
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.+?)(\.[A-Za-z]+)?$", 1)
    found = files.select(name, "value").collect()
    return {n: (label(n), text) for n, text in sorted(found) if words(text)}


def scan(
    docs: DataFrame,
    templates: Mapping[str, tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Words, phrases, labels and the best containment of every row.

    A null text is an empty one, without words or labels; a very long one is scanned whole;
    a repeated row has the same result each time, and an empty table none.  Of templates met
    to an equal share all labels count.  Columns other than ``doc_id, text`` are ignored,
    whatever their names.
    """
    found = stored(scanned(docs, templates, threshold), "scanned")
    counts = (
        found.where("counts IS NOT NULL")
        .select(F.explode("counts").alias("word", "n"))
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    rows = found.where("counts IS NULL").drop("counts")
    key = F.struct("doc_id", "text_hash")
    blocks = rows.select(key.alias("block"), F.explode("blocks").alias("b")).select(
        "block", "b.words", "b.size"
    )
    labels = docs.sparkSession.createDataFrame(
        [(name, own) for name, (own, _) in templates.items()], "template string, label string"
    )
    # One row a template, as those that `matches` holds.
    best = (
        matches(blocks, counts, templates, threshold)
        .join(F.broadcast(labels), "template")
        .groupBy("block")
        .agg(
            F.collect_set("label").alias("more"),
            F.max("containment").alias("score"),
        )
        if templates
        else None
    )
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word"]
    if best is None:
        joined = rows.withColumns({"more": F.array().cast("array<string>"), "score": F.lit(0.0)})
    else:
        same = F.col("doc_id").eqNullSafe(F.col("block.doc_id")) & (
            F.col("text_hash") == F.col("block.text_hash")
        )
        joined = rows.drop("blocks").join(best, same, "left")
    every = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return joined.select(
        *columns,
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )

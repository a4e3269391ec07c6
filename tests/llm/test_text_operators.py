"""Quality, lines, licenses, personal data, syncmers and BPE against plain Python."""

import base64
import hashlib
import random
import re
import textwrap
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quaymart.llm import bpe, licenses, line_dedup, pii, quality, syncmers
from quaymart.llm import queries as llm_queries
from quaymart.llm.sql import SQL
from tests.helpers import plan
from tests.llm.helpers import FOLDER, LONG, TEXTS, documents, empty, table, values

WORD = re.compile(r"[^ \t-\r]+")
OPERATORS = {
    "quality": quality.quality,
    "lines": line_dedup.dedup_lines,
    "cleaned": line_dedup.cleaned,
    "licenses": licenses.scan,
    "pii": pii.scan,
    "syncmers": syncmers.fingerprints,
    "bpe": bpe.round_trip,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_and_no_rows(spark, name):
    rows = OPERATORS[name](documents(spark)).collect()
    assert len(rows) == len(TEXTS)
    assert OPERATORS[name](empty(spark)).collect() == []


@pytest.mark.parametrize("name", ["op1_line_dedup", "op10_quality", "op8_url_filter"])
def test_native_plans(spark, name):
    text = plan(llm_queries.QUERIES[name](spark, FOLDER))
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", text)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for name_of in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name_of} AS SELECT * FROM '{FOLDER}/{name_of}.parquet'")
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    found = llm_queries.QUERIES[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(columns)
    key = lambda r: [(v is not None, str(type(v)), v) for v in r]
    assert values(found, *columns) == sorted(map(tuple, cursor.fetchall()), key=key)


def plain_quality(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in quality.SYMBOLS for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality(spark):
    docs = documents(spark).unionByName(table(spark, "documents"), allowMissingColumns=True)
    found = values(quality.quality(docs), "doc_id", *quality.FEATURES[:5], "base_failed", "kept")
    expected = []
    for row in docs.select("doc_id", "text").collect():
        f = plain_quality(row.text)
        expected.append((row.doc_id, *f, f[0] < 50 or 100 * f[4] > 50 * f[0]))
    key = lambda r: [(v is not None, v) for v in r]
    assert sorted((r[:-1] for r in found), key=key) == sorted(expected, key=key)
    assert not any(r[-1] and r[-2] for r in found)


def test_keep_good_keeps_columns_and_good_documents(spark):
    docs = documents(spark).unionByName(table(spark, "documents"), allowMissingColumns=True)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    good = table(spark, "labels").join(table(spark, "documents"), "doc_id").where("quality = 1")
    rows = good.select("doc_id", "text").collect()
    clean = {r.doc_id for r in rows if not plain_quality(r.text)[0] < 50}
    assert len(clean - ids) <= 0.02 * len(clean)


def test_line_dedup(spark):
    found = values(line_dedup.dedup_lines(documents(spark)), "row.doc_id", "text", "n_lines", "n_removed")
    # "shared line of words" is on a, b, c, d and e; its first place is in document 1.
    by_id = defaultdict(list)
    for doc_id, *rest in found:
        by_id[doc_id].append(tuple(rest))
    assert by_id[1] == [(TEXTS[0][1], 3, 0)]
    assert by_id[4] == [("one two three four five six\n", 3, 1)] * 2
    assert by_id[None] == [("no id here, but", 2, 1)]
    assert by_id[9] == [("a\na\nb", 5, 2)]
    assert by_id[2] == by_id[3] == [("", 1, 0)]
    assert by_id[8] == [(LONG, 1, 0)]


@pytest.mark.parametrize("least", [2, 5, 30])
def test_line_spread_is_exact_near_the_threshold(spark, least):
    rows = [
        (site, f"line on {n} sites here", "en", f"s{site}")
        for n in (least - 1, least, least + 1)
        for site in range(n)
    ]
    docs = documents(spark, rows)
    found = line_dedup.dedup_lines(docs, min_sites=least).where("n_removed > 0")
    texts = {r.t for r in found.selectExpr("row.text AS t").collect()}
    assert texts == {f"line on {n} sites here" for n in (least, least + 1)}


def plain_blocks(text, templates=licenses.TEMPLATES):
    """Lines, and from each line on as many as hold the longest template begun in it."""
    longest = max(len(licenses.words(t)) for _, t in templates.values())
    blocks = text.split("\n")
    for paragraph in re.split(r"\n(?:\s*\n)+", text):
        lines = [x for x in paragraph.split("\n") if licenses.words(x)]
        for first in range(len(lines)):
            end, held = first + 1, 0
            while end < len(lines) and held < longest - 1:
                held += len(licenses.words(lines[end]))
                end += 1
            blocks.append("\n".join(lines[first:end]))
    return blocks


def plain_licenses(text, templates=licenses.TEMPLATES):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = []
    for phrase, label in licenses.PHRASES.items():
        places += [(i, label) for i in range(len(words)) if tuple(words[i : i + len(phrase)]) == phrase]
    score, labels = 0.0, {label for _, label in places}
    for label, template in templates.values():
        own = set(licenses.words(template))
        for line in plain_blocks(text or "", templates):
            shared = len(own & set(licenses.words(line))) / len(own)
            if shared >= licenses.THRESHOLD:
                score = max(score, shared)
                labels.add(label)
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), score,
    )


LICENSED = [
    (1, "Under the MIT\nLicense, mit license. GENERAL public LICENSE general public", "en", "a"),
    (2, "x\nThis work is licensed under the GNU General Public License, version 3.\ny", "en", "a"),
    (3, "Licensed under CC BY-NC 4.0.", "en", "a"),
    (4, "apache\u00a0license apache license2 apache-license", "en", None),
    (5, "mit mit license license", None, None),
    (6, "Redistribution and use in source and binary forms, with modification, are permitted "
        "provided that the following conditions are met: " + "word " * 500, "en", "a"),
]


def test_licenses(spark):
    docs = documents(spark, TEXTS + LICENSED).unionByName(
        table(spark, "documents"), allowMissingColumns=True
    )
    found = values(licenses.scan(docs))
    expected = [(r.doc_id, *plain_licenses(r.text)) for r in docs.select("doc_id", "text").collect()]
    key = lambda r: [(v is not None, v) for v in r]
    assert sorted(found, key=key) == sorted(expected, key=key)
    assert any(r[6] == "cc-by-nc" for r in found)


def test_licenses_broken_over_lines(spark):
    rows = []
    for i, (_, template) in enumerate(licenses.TEMPLATES.values()):
        for j, width in enumerate((12, 30, 72)):
            lines = textwrap.wrap("some words first " + template + " and words after", width, break_long_words=False)
            rows.append((100 * i + j, "x\n\n# " + "\n# ".join(lines) + "\n\ny", "en", "a"))
        rows.append((100 * i + 50, template.replace(" ", "\n\n"), "en", "a"))
    found = {r.doc_id: r for r in licenses.scan(documents(spark, rows)).collect()}
    for i, (label, template) in enumerate(licenses.TEMPLATES.values()):
        for j in range(3):
            assert label in found[100 * i + j].labels.split(",")
            assert found[100 * i + j].score == 1.0
        assert found[100 * i + 50].score == 0.0


@pytest.fixture(scope="module")
def license_folder(tmp_path_factory):
    """Many long texts that share most of their words, a text a file."""
    folder = tmp_path_factory.mktemp("licenses")
    rng = random.Random(4)
    for i in range(120):
        text = [f"term{int(400 * rng.random() ** 2)}" for _ in range(rng.randint(20, 200))]
        (folder / f"lic-{i}.0.txt").write_text(textwrap.fill(" ".join(text), 70))
    (folder / "empty.txt").write_text(" \n")
    return folder


def test_licenses_of_a_folder(spark, license_folder):
    templates = licenses.read_templates(spark, str(license_folder), lambda n: n.split(".")[0])
    assert len(templates) == 120 and templates["lic-7.0"][0] == "lic-7"
    rng = random.Random(5)
    rows = []
    for i, (_, text) in enumerate(list(templates.values())[::6]):
        words = text.split()
        for j, share in enumerate((0.7, 0.8, 0.85, 1.0)):
            kept = [w for w in words if rng.random() < share]
            rows.append((10 * i + j, textwrap.fill(" ".join(kept), 60), "en", "a"))
        rows.append((10 * i + 5, " ".join(words + words), "en", None))
    found = values(licenses.scan(documents(spark, rows), templates))
    assert found == sorted(
        ((doc_id, *plain_licenses(text, templates)) for doc_id, text, _, _ in rows),
        key=lambda r: [(v is not None, str(type(v)), v) for v in r],
    )
    assert {r[-1] == 0.0 for r in found} == {True, False}


def test_licenses_plan_does_not_grow_with_the_templates(spark, license_folder):
    templates = licenses.read_templates(spark, str(license_folder))
    few = dict(list(templates.items())[:3])
    sizes = [len(plan(licenses.scan(documents(spark), some))) for some in (few, templates)]
    assert sizes[1] < 1.2 * sizes[0]


def test_license_folder_beyond_its_bound(spark, license_folder, monkeypatch):
    monkeypatch.setattr(licenses, "TEMPLATE_BYTES", 1000)
    with pytest.raises(ValueError, match="at most 1000"):
        licenses.read_templates(spark, str(license_folder))


def plain_spans(text):
    """The formats as they are stated, by ordinary searches."""
    found = [
        (m.start(), 0, m.end())
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    ]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(int(x) if i % 2 == 0 else sum(map(int, str(2 * int(x)))) for i, x in enumerate(d[::-1]))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.@-+1290 ()_%\n\u00e9\U0001f600", max_size=60))
def test_spans_are_those_of_the_plain_searches(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_long_runs_are_searched_in_linear_time():
    for run in ("a" * 400_000, "1" * 300_000, "1." * 200_000, "a.a@" * 50_000, "+1 " * 100_000):
        pii.instances(run, pii.base_spans(run))


def test_pii_base_and_discovery(spark):
    rows = [
        (i, f"é my card number is {4111111111111111 if i % 2 else 4012888888881881} ok {i}", "en", "a")
        for i in range(3)
    ]
    valid = [n for n in range(4_000_000_000_000_000, 4_000_000_000_000_400) if pii.luhn(str(n))]
    rows += [(10 + i, f"pay with card no. {n} today", "en", "a") for i, n in enumerate(valid[:12])]
    rows += [(100, "pay with card no. 4000000000000003 today", "en", "a")]  # fails the check digit
    rows += [(101, "seen in 1234567890123 words", "en", "a")]
    rows += [(102, None, "en", "a"), (103, "mail joe@x.org now +1 (212) 555-0100 or 10.0.0.256", "en", "a")]
    docs = documents(spark, rows)
    found = {r.doc_id: r for r in pii.scan(docs).collect()}
    for doc_id, text, *_ in rows:
        spans = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(text or "")]
        row = found[doc_id]
        assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(filter(None, row.spans.split(",")))
        for k in pii.KINDS:
            assert row[f"n_{k}"] == sum(s.startswith(k) for s in spans)
    assert found[100].spans == "card:18:34" and found[100].n_card == 0
    assert found[101].spans == ""


def test_places_of_known_values_that_the_formats_pass_over(spark):
    card, other = "4111111111111111", "4012888888881881"
    rows = [
        (1, f"card {card} here", "en", "a"),
        (2, f"cards {other} {card} here", "en", "a"),  # 32 digits to the format
        (3, f"{card} 123 and 99 {card}", "en", "a"),  # with a number after and before it
        (4, f"plain {card}", "en", "a"),
    ]
    found = {r.doc_id: r for r in pii.scan(documents(spark, rows)).collect()}
    assert [found[i].n_card for i in (1, 2, 3, 4)] == [1, 0, 0, 1]
    assert found[1].spans == "card:5:21" and found[4].spans == "card:6:22"
    assert found[2].spans == "card:23:39"
    assert found[3].spans == "card:0:16,card:28:44"


def test_context_has_no_bound():
    long = "w" * 300
    text = f"x {long}   {long}1  {'y' * 100} 4111111111111111" + " " * 200 + f"{long}2 z"
    (found,) = [i for i in pii.instances(text, pii.base_spans(text)) if i["seed"]]
    words = [pii._masked(w) for w in (long + "1", "y" * 100, long + "2")]
    assert found["patterns"] == [f"{words[0]} {words[1]} _", f"{words[1]} _ {words[2]}"]
    # Digits are alike, so two of the words are.
    assert len(set(words)) == 2 and pii._masked(long) not in words
    glued = "to:4111111111111111,4012888888881881! end"
    first, second = [i["patterns"] for i in pii.instances(glued, pii.base_spans(glued)) if i["seed"]]
    assert first == ["^ to _", "to _ end"] and second == ["^  _", " _ end"]


def plain_bootstrap(graph, min_seeds=5, min_pattern=0.8, min_instance=0.9):
    """Patterns and instances scored in turn until nothing is added, in plain Python."""
    edges = {(k, v, p) for k, v, _, p in graph}
    score = {(k, v): 1.0 for k, v, seed, _ in graph if seed}
    while True:
        trust = {}
        for pattern in {(k, p) for k, _, p in edges}:
            values = [(k, v) for k, v, p in edges if (k, p) == pattern]
            known = [score[x] for x in values if x in score]
            if len(known) >= min_seeds and sum(known) / len(values) >= min_pattern:
                trust[pattern] = sum(known) / len(values)
        new = {}
        for k, v, p in edges:
            if (k, v) not in score and (k, p) in trust:
                new[k, v] = new.get((k, v), 1.0) * (1 - min(trust[k, p], 0.999))
        new = {x: 1 - doubt for x, doubt in new.items() if 1 - doubt >= min_instance}
        if not new:
            return set(score)
        score |= new


def test_bootstrapping_follows_chains_of_patterns_to_their_end(spark):
    """Eight patterns, each trusted by what the one before discovers; and some that are not."""
    graph = [(2, v, True, "p0") for v in range(20)]
    for step in range(8):
        graph += [(2, 100 * (step + 1) + v, False, f"p{step}") for v in range(2)]
        values = [100 * (step + 1) + v for v in range(2)] + list(range(18))
        graph += [(2, v, v < 20, f"p{step + 1}") for v in values]
    graph += [(2, 5000 + v, False, "p8") for v in range(30)]  # too many strangers
    graph += [(3, 9, False, "p0"), (3, 8, True, "q"), (3, 7, False, "q")]  # another kind
    columns = "kind int, value long, seed boolean, pattern string"
    found = pii.bootstrap(spark.createDataFrame(graph, columns))
    expected = plain_bootstrap(graph)
    assert {tuple(r) for r in found.collect()} == expected
    assert (2, 801) in expected and (2, 5000) not in expected


def test_likeness_against_all_anchors(spark):
    """Sketches grow with the text, and likeness is near that over every anchor."""
    texts = [r.text for r in table(spark, "documents").select("text").collect() if len(r.text or "") > 1500]
    errors = []
    for one, other in zip(texts, texts[1:]):
        changed = syncmers.edited(one, other)
        a, b = syncmers.sketch(one), syncmers.sketch(changed)
        every = [set((syncmers.anchors(t)[0] >> np.uint64(32)).tolist()) for t in (one, changed)]
        exact = 2 * len(every[0] & every[1]) / (len(every[0]) + len(every[1]))
        errors.append(abs(syncmers.likeness(a, b) - exact))
        for held, whole in zip((a, b), every):
            kept = set(held[0].tolist())
            assert kept == (whole if len(whole) <= syncmers.SHORT else {h for h in whole if h < syncmers.BOUND})
    assert len(errors) > 20 and np.mean(errors) < 0.05


@pytest.mark.parametrize("gap", [0, 300, 70_000])
def test_fingerprints_hold_every_anchor_of_long_texts(spark, gap):
    """Equal to sets of all anchors, also where positions are far apart."""
    words = [f"{n * n * 7919 % 100_003} word{n}" for n in range(4000)]
    one = " ".join(words[:2000]) + "x" * gap + " ".join(words[2000:])
    other = " ".join(words[:1500])
    docs = spark.createDataFrame([(1, one), (2, other)], "doc_id long, text string")
    found = {r.doc_id: r for r in syncmers.fingerprints(docs).collect()}
    changed = syncmers.edited(one, other)
    every = {t: {h >> 32 for h in syncmers.anchors(t)[0].tolist()} for t in (one, other, changed)}
    assert min(map(len, every.values())) > 2000
    shared = 2 * len(every[one] & every[other]) / (len(every[one]) + len(every[other]))
    assert found[1].near_next == shared  # all on one diagonal
    assert set(syncmers.decoded(found[1].fingerprint)[0].tolist()) == every[one]
    assert set(syncmers.decoded(found[1].edited_fingerprint)[0].tolist()) == every[changed]
    first = {}
    for h, p in zip(*(x.tolist() for x in syncmers.anchors(one)), strict=True):
        first.setdefault(h >> 32, p)
    assert dict(zip(*(x.tolist() for x in syncmers.decoded(found[1].fingerprint)))) == first
    for near, text in (("near_next", found[2].fingerprint), ("near_edited", found[1].edited_fingerprint)):
        again = syncmers.likeness(syncmers.decoded(found[1].fingerprint), syncmers.decoded(text))
        assert found[1][near] == again


def test_syncmers_depend_on_their_own_characters_only():
    text = "the quick brown fox jumps over the lazy dog, again and again and yet again"
    base = {text[p : p + syncmers.K] for p in syncmers.anchors(text)[1].tolist()}
    more = "xyz " + text + " and more"
    found = {more[p : p + syncmers.K] for p in syncmers.anchors(more)[1].tolist()}
    assert base and base <= found


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="ab c\u00e9", min_size=16, max_size=80))
def test_anchors_are_the_closed_syncmers(text):
    codes = np.array([ord(c) + 1 for c in text], np.uint64)
    small = syncmers._mixed(syncmers._grams(codes, syncmers.S)).tolist()
    width = syncmers.K - syncmers.S + 1
    expected = []
    for i in range(len(text) - syncmers.K + 1):
        window = small[i : i + width]
        if min(window) in (window[0], window[-1]):
            expected.append(i)
    assert syncmers.anchors(text)[1].tolist() == (expected or [0])  # else the whole text


def test_syncmer_fingerprints(spark):
    docs = table(spark, "documents").select("doc_id", "text")
    rows = sorted(map(tuple, docs.collect()))
    found = {r.doc_id: r for r in syncmers.fingerprints(docs).collect()}
    near, strange, by_text = [], [], defaultdict(set)
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        row = found[doc_id]
        changed = syncmers.edited(text, following)
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert row.edited_fingerprint == syncmers.fingerprint(changed)
        by_text[text].add(row.fingerprint)
        if len(text) > 200 and text != following:
            near.append(row.near_edited)
            strange.append(row.near_next)
    assert all(len(x) == 1 for x in by_text.values())
    assert sorted(near)[len(near) // 20] > 0.5 and sorted(strange)[-len(strange) // 20] < 0.2


def test_bpe_is_that_of_the_other_library(spark):
    ranks = public_tokenizers.path(bpe.RANKS)
    with open(ranks, "rb") as lines:
        table_ = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    other = tiktoken.Encoding(
        "other", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table_, special_tokens={}
    )
    odd = [
        (20, "<|endoftext|> 'S don't  \n\n  x\t", "en", "a"),
        (21, "x" * 5000 + " " * 300 + "é" * 400, "en", "a"),
    ]
    docs = documents(spark, TEXTS + odd).unionByName(
        table(spark, "documents"), allowMissingColumns=True
    )
    found = values(bpe.round_trip(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    expected = []
    for r in docs.select("doc_id", "text").collect():
        ids = other.encode_ordinary(r.text or "")
        digest = lambda b: hashlib.sha256(b).hexdigest()
        expected.append(
            (r.doc_id, len(ids), digest(" ".join(map(str, ids)).encode()), digest((r.text or "").encode()))
        )
    assert found == sorted(expected, key=lambda r: [(v is not None, str(type(v)), v) for v in r])


def test_decoding_reverses_the_byte_table():
    path = public_tokenizers.path(bpe.RANKS)
    coder = bpe.codec(path, public_tokenizers.PATTERN)
    with open(path, "rb") as lines:
        ranks = dict(line.split() for line in lines)
    assert len(ranks) == len(coder._bytes)
    for token, rank in ranks.items():
        assert coder.decode(np.array([int(rank)])) == base64.b64decode(token)


def test_bpe_offsets_and_split_characters(spark):
    text = "né 漢字\U0001f600 end"
    row = bpe.encode(documents(spark, [(1, text, "en", "a")]), offsets=True).first()
    coder = bpe.codec(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)
    assert coder.decode(np.array(row.ids)).decode() == text
    tokens = [coder.decode(np.array([i])) for i in row.ids]
    shown = [text[a:b].encode() for a, b in zip(row.first, row.end, strict=True)]
    assert all(t in s for t, s in zip(tokens, shown, strict=True))
    assert any(len(t) < len(s) for t, s in zip(tokens, shown, strict=True))

"""Operators against plain Python on random rows, a third of them on one key."""

from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quaymart.operators import (
    header_detail_rollup,
    keep_first,
    membership_flags,
    merge_lookups,
    one_value_per_key,
    rollup,
    sums_by_category,
    unstable_keys,
)
from tests.helpers import rows

KEYS = st.one_of(st.just("hot"), st.sampled_from("abcdefgh"), st.none())
NUMBERS = st.one_of(st.none(), st.integers(-5, 20))
ROWS = st.lists(
    st.tuples(KEYS, st.sampled_from(["x", "y", "z", None]), NUMBERS), max_size=40
)
few = settings(max_examples=12, deadline=None)


def total(values):
    kept = [v for v in values if v is not None]
    return sum(kept) if kept else None


def frame(spark, found):
    return spark.createDataFrame(found, "k string, c string, n int")


def in_order(found):
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])


@few
@given(ROWS)
def test_pivot_sums(spark, found):
    groups = defaultdict(list)
    for k, c, n in found:
        groups[k].append((c, n))
    expected = [
        (k, len(g), *[total(n for c, n in g if c == name) for name in ("x", "y")])
        for k, g in groups.items()
    ]
    measures = {"all": F.count("*"), **sums_by_category("c", "n", {"x": "x", "y": "y"})}
    assert rows(rollup(frame(spark, found), ["k"], measures)) == in_order(expected)


@few
@given(ROWS)
def test_header_detail(spark, found):
    """The header is the key and a number; its category rows are the details."""
    headers = {(k, n) for k, _, n in found}
    expected = [
        (
            k,
            total(n for key, n in headers if key == k),
            total(1 for key, c, _ in found if key == k and c == "x"),
        )
        for k in {k for k, _, _ in found}
    ]
    got = header_detail_rollup(
        frame(spark, found).withColumn("one", F.lit(1)),
        ["k", "n"],
        ["k"],
        {"n": F.col("n")},
        sums_by_category("c", "one", {"x": "x"}),
    )
    assert rows(got) == in_order(expected)


@few
@given(ROWS, st.lists(KEYS, max_size=6), st.lists(KEYS, max_size=6))
def test_membership(spark, found, one, two):
    expected = [
        (k, *[int(k is not None and k in other) for other in (one, two)])
        for k in {k for k, _, _ in found}
    ]
    others = {
        name: (spark.createDataFrame([(v,) for v in values], "v string"), "v")
        for name, values in (("one", one), ("two", two))
    }
    assert rows(membership_flags(frame(spark, found), "k", others)) == in_order(expected)


@few
@given(ROWS)
def test_lookups_and_first_rows(spark, found):
    keyed = [(k, c, n) for k, c, n in found if None not in (k, c, n)]
    df = frame(spark, keyed)
    pairs = df.select("k", "c")
    smallest, first, variants = {}, {}, defaultdict(set)
    for k, c, n in keyed:
        smallest[k] = min(smallest.get(k, c), c)
        first[k] = min(first.get(k, (n, c)), (n, c))
        variants[k].add(c)
    merged = merge_lookups([pairs, pairs])
    assert dict(rows(one_value_per_key(merged, "k", "c"))) == smallest
    got = keep_first(df, ["k"], ["n", "c"])
    assert {k: (n, c) for k, c, n in rows(got)} == first
    assert dict(rows(unstable_keys(df, ["k"], ["c"]))) == {
        k: len(v) for k, v in variants.items() if len(v) > 1
    }

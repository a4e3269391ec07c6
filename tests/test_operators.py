import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quaymart.operators import (
    InvalidLookup,
    QualityError,
    Reference,
    ambiguous_keys,
    attribute_variants,
    broadcast_if_small,
    clean_lookup,
    collected,
    column_info,
    counts_by_category,
    coverage_totals,
    distinct_counts,
    distinct_profile,
    enforce,
    header_detail_rollup,
    join_measures,
    keep_first,
    map_through,
    matched_rows,
    membership_flags,
    merge_lookups,
    null_profile,
    numeric_summary,
    one_value_per_key,
    orphans,
    hot_values,
    join_hot,
    join_labels,
    merge_sketches,
    prepare_lookups,
    sketch_quantile,
    value_sketches,
    reconcile,
    reconcile_totals,
    rollup,
    schema_difference,
    share_of_total,
    span,
    sums_by_category,
    table_checks,
    unstable_keys,
    value_counts,
    wide_profile,
    with_labels,
)
from tests.helpers import final_plan, plan, rows

# ------------------------------------------------------------------- labels


def codes(spark, *pairs):
    return spark.createDataFrame(list(pairs), "code string, label string")


def test_labels_keep_unmatched_rows(spark):
    df = spark.createDataFrame([(1.0,), (9.0,), (None,)], "code double")
    lookups = prepare_lookups(
        {"code": codes(spark, ("1", "Air"), ("2", "Sea"))}, {"code": DoubleType()}
    )
    assert rows(with_labels(df, lookups)) == [(None, None), (1.0, "Air"), (9.0, None)]


def test_labels_chain(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    first = spark.createDataFrame([(1, 7), (2, 8)], "a int, b int")
    second = spark.createDataFrame([(7, "x")], "b int, c string")
    got = with_labels(df, {"a": first, "b": second})
    assert rows(got, "a", "c") == [(1, "x"), (2, None)]


@pytest.mark.parametrize(
    "pairs, message",
    [
        ([("1", "a"), ("1", "b")], "1 rows repeat a code"),
        ([("1", "a"), (None, "b")], "1 rows without a usable code"),
        ([("1", "a"), ("x", "b")], "1 rows without a usable code"),
    ],
)
def test_invalid_lookups_are_refused(spark, pairs, message):
    with pytest.raises(InvalidLookup, match=message):
        prepare_lookups({"code": codes(spark, *pairs)}, {"code": DoubleType()})


def test_empty_lookup_is_accepted(spark):
    lookups = prepare_lookups({"code": codes(spark, ("1", "a")).limit(0)}, {})
    df = spark.createDataFrame([("1",)], "code string")
    assert rows(with_labels(df, lookups)) == [("1", None)]


def test_broadcast_only_within_the_bounds(spark):
    lookup = spark.range(100).withColumn("text", F.lit("x" * 10))
    df = spark.range(1000)
    for limits, broadcast in [
        ({"max_rows": 100, "max_bytes": 10_000}, True),
        ({"max_rows": 99, "max_bytes": 10_000}, False),
        ({"max_rows": 100, "max_bytes": 100}, False),
    ]:
        checked = broadcast_if_small(lookup, **limits)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            text = plan(df.join(checked, "id"))
            assert ("BroadcastHashJoin" in text) == broadcast
            assert df.join(checked, "id").count() == 100
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ------------------------------------------------------------------ lookups


def test_clean_lookup(spark):
    df = spark.createDataFrame(
        [("CA", "Quincy"), (None, "Quincy"), ("MA", None), ("None", "A"), ("MA", "None")],
        "state_id string, City string",
    )
    assert rows(clean_lookup(df)) == [("CA", "Quincy")]
    assert len(rows(clean_lookup(df, placeholder=None))) == 3


def test_merge_matches_columns_by_name_and_keeps_one_value(spark):
    a = spark.createDataFrame([("MA", "Quincy"), ("CA", "Quincy")], "s string, c string")
    b = spark.createDataFrame([("Quincy", "MA"), ("Ames", "IA")], "c string, s string")
    pairs = merge_lookups([a, b])
    assert rows(pairs, "c", "s") == [("Ames", "IA"), ("Quincy", "CA"), ("Quincy", "MA")]
    assert rows(one_value_per_key(pairs, "c", "s")) == [("Ames", "IA"), ("Quincy", "CA")]
    assert rows(ambiguous_keys(pairs, "c", "s")) == [("Quincy", 2)]


def test_map_through_drops_unmapped_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    lookup = spark.createDataFrame([("a", "A"), ("c", "C")], "k string, s string")
    assert rows(map_through(df, lookup, "k")) == [("a", 1, "A")]


def test_keep_first_with_one_dominant_key(spark):
    df = spark.range(3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        (3000 - F.col("id")).alias("v"),
    )
    got = keep_first(df, ["k"], ["v"])
    best = {}
    for i in range(3000):
        k = 0 if i % 3 == 0 else i
        best[k] = min(best.get(k, 9999), 3000 - i)
    assert dict(rows(got, "k", "v")) == best
    text = plan(got)
    assert text.index("WindowGroupLimit") < text.index("Exchange")
    assert text.count("WindowGroupLimit") == 2


# ------------------------------------------------------------------ roll-ups


@pytest.fixture
def trips(spark):
    return spark.createDataFrame(
        [
            ("CA", "Air", 1),
            ("CA", "Air", 2),
            ("CA", None, 4),
            ("NY", "Sea", 8),
            ("NY", "Other", 16),
            (None, "Sea", 32),
        ],
        "state string, mode string, n int",
    )


def test_counts_by_category(trips):
    names = {"Air": "air", "Sea": "sea", "Land": "land"}
    measures = {"total": F.count("*"), **counts_by_category("mode", names)}
    assert rows(rollup(trips, ["state"], measures)) == [
        (None, 1, None, 1, None),
        ("CA", 3, 2, None, None),
        ("NY", 2, None, 1, None),
    ]
    filled = rollup(trips, ["state"], counts_by_category("mode", names, fill_zero=True))
    assert rows(filled) == [(None, 0, 1, 0), ("CA", 2, 0, 0), ("NY", 0, 1, 0)]


def test_sums_by_category(trips):
    names = {"Air": "air", "Sea": "sea"}
    assert rows(rollup(trips, ["state"], sums_by_category("mode", "n", names))) == [
        (None, None, 32),
        ("CA", 3, None),
        ("NY", None, 8),
    ]


def test_rollup_is_one_shuffle(trips):
    measures = {
        "total": F.count("*"),
        "lowest": F.min("n"),
        "highest": F.max("n"),
        "mean": F.avg("n"),
        "median": F.percentile_approx("n", 0.5),
        **counts_by_category("mode", {"Air": "air", "Sea": "sea"}),
    }
    text = plan(rollup(trips, ["state"], measures))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_median_is_the_lower_middle_value(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 10, 20)], "v int")
    got = rollup(df, [], {"median": F.percentile_approx("v", 0.5, 10_000)})
    assert rows(got) == [(2,)]


def test_header_detail_rollup(spark):
    df = spark.createDataFrame(
        [
            ("A", "CA", 100, "x", 1),
            ("A", "CA", 100, "y", 2),
            ("A", "CA", 100, "x", 4),
            ("B", "CA", 50, "x", 8),
            ("C", "NY", None, "y", 16),
        ],
        "city string, `state code` string, pop int, race string, n int",
    )
    got = header_detail_rollup(
        df,
        ["city", "state code", "pop"],
        ["state code"],
        {"pop": F.col("pop")},
        sums_by_category("race", "n", {"x": "x", "y": "y", "z": "z"}),
    )
    assert rows(got) == [("CA", 150, 13, 2, None), ("NY", None, None, 16, None)]
    text = plan(got)
    assert text.count("Scan") == 1 and "Join" not in text


def test_join_measures(spark):
    base = spark.createDataFrame([(1,), (2,)], "k int")
    a = spark.createDataFrame([(1, 10)], "k int, a int")
    b = spark.createDataFrame([(2, 20), (3, 30)], "k int, b int")
    assert rows(join_measures(base, [a, b], ["k"])) == [(1, 10, None), (2, None, 20)]


def test_share_of_total(spark):
    df = spark.createDataFrame(
        [("a", 1, 0), ("b", 3, 0), ("c", None, 0)], "k string, x int, z int"
    )
    got = share_of_total(df, {"px": ("x", 2), "pz": ("z", 2)})
    assert rows(got, "k", "px", "pz") == [
        ("a", 25.0, None),
        ("b", 75.0, None),
        ("c", None, None),
    ]
    text = plan(got)
    assert "Window" not in text and "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text


def test_shares_of_grouped_rows_group_them_once(spark):
    grouped = rollup(
        spark.range(100).select((F.col("id") % 7).alias("k"), F.lit(1).alias("v")),
        ["k"],
        {"n": F.sum("v"), "m": F.count("*")},
    )
    text = final_plan(share_of_total(grouped, {"pn": ("n", 2), "pm": ("m", 2)}))
    assert "ReusedExchange" in text and "ReusedSubquery" in text


# ----------------------------------------------------------------- profiles


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(
        [("a", 1, 1.0), ("a", 2, None), (None, 2, None), ("b", 2, 4.0)],
        "name string, `the code` int, amount double",
    )


def test_null_profile(sample):
    assert rows(null_profile(sample)) == [
        ("amount", 4, 2, 50.0),
        ("name", 4, 1, 25.0),
        ("the code", 4, 0, 0.0),
    ]
    text = plan(null_profile(sample))
    assert text.count("Scan") == 1 and text.count("Exchange") == 1


def test_null_profile_of_an_empty_table(sample):
    assert rows(null_profile(sample.limit(0), ["name"])) == [("name", 0, 0, None)]


def test_column_info(sample):
    assert rows(column_info(sample)) == [
        ("amount", "double", 2),
        ("name", "string", 3),
        ("the code", "int", 4),
    ]


def test_numeric_summary(sample):
    (row,) = rows(numeric_summary(sample, ["amount"]))
    assert row[:3] == ("amount", 2, 2.5) and row[4:] == (1.0, 4.0)
    assert row[3] == pytest.approx(2.1213203)


def test_span(sample):
    assert rows(span(sample, ["the code", "amount"])) == [(1, 2, 1.0, 4.0)]


def test_value_counts(sample):
    assert rows(value_counts(sample, ["name", "the code"])) == [
        ("name", None, 1),
        ("name", "a", 2),
        ("name", "b", 1),
        ("the code", "1", 1),
        ("the code", "2", 3),
    ]


def test_distinct_profile(sample):
    got = distinct_profile(sample, ["name", "the code"], sample=2).collect()
    found = {
        r["column_name"]: (r["distinct_count"], [tuple(s) for s in r["sample_values"]])
        for r in got
    }
    assert found == {
        "name": (3, [("a", 2), ("b", 1)]),
        "the code": (2, [("1", 1), ("2", 3)]),
    }


def test_distinct_profile_counts_values_once(sample):
    assert "ReusedExchange" in final_plan(distinct_profile(sample, ["name"], sample=2))


def by_column(profile):
    return {r["column_name"]: r for r in profile.collect()}


def test_wide_profile_against_plain_counts(spark):
    # A value at the bound, one just below it, one half, many rare ones, a key, both zeros.
    def row(i):
        hot = "hot" if i % 2 else f"rare {i}"
        edge = "at" if i < 400 else "below" if i < 799 else f"x{i}"
        zero = -0.0 if i % 2 else 0.0
        return i, hot, edge, zero, None if i % 4 == 0 else i % 3000, [i % 2], None

    data = [row(i) for i in range(40_000)]
    df = spark.createDataFrame(
        data, "key int, hot string, `ed.ge` string, zero double, some int, `list` array<int>, "
        "nothing string"
    ).repartition(7)
    got = by_column(wide_profile(df))
    texts = {"key": str, "hot": str, "ed.ge": str, "zero": lambda v: "0.0", "some": str,
             "list": lambda v: f"[{v[0]}]", "nothing": str}
    for at, (name, text) in enumerate(texts.items()):
        filled = [text(r[at]) for r in data if r[at] is not None]
        counts = Counter(filled)
        frequent = sorted(
            ((v, n) for v, n in counts.items() if n * 100 >= len(data)),
            key=lambda x: (-x[1], x[0]),
        )
        r = got[name]
        assert r["row_count"] == len(data) and r["null_count"] == len(data) - len(filled)
        assert [tuple(x) for x in r["frequent_values"]] == frequent
        known = len(counts) <= 1000 or len(counts) * 100 >= len(filled) * 99
        assert r["distinct_count"] == (len(counts) if known else None)
        assert abs(r["distinct_estimate"] - len(counts)) <= 0.05 * len(counts)
    assert [tuple(x) for x in got["ed.ge"]["frequent_values"]] == [("at", 400)]


def test_wide_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "column_name string, value double")
    for r in wide_profile(df).collect():
        assert (r["row_count"], r["distinct_estimate"], r["distinct_count"]) == (0, 0, 0)
        assert r["frequent_values"] == []


def test_wide_profile_reads_no_column_twice_without_need(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20_000).select(
        (F.col("id") % 5000).alias("middle"), (F.col("id") % 3).alias("small")
    ).write.parquet(path)
    profile = wide_profile(spark.read.parquet(path))
    (scan,) = re.findall(r"ReadSchema: (.*)", plan(profile))
    assert "small" in scan and "middle" not in scan


def test_variants(spark):
    df = spark.createDataFrame(
        [("x", 1), ("x", 1), ("y", 1), ("y", 2), ("z", None), ("z", 1)],
        "city string, lat int",
    )
    variants = attribute_variants(df, ["city"], ["lat"])
    assert [tuple(r) for r in variants.collect()] == [
        ("x", 1),
        ("y", 1),
        ("y", 2),
        ("z", None),
        ("z", 1),
    ]
    assert rows(unstable_keys(df, ["city"], ["lat"])) == [("y", 2), ("z", 2)]


def test_schema_difference(spark):
    a = spark.createDataFrame([], "x int, y int, z string")
    b = spark.createDataFrame([], "y int, z int, w int")
    assert schema_difference(a, b) == {
        "only_left": ["x"],
        "only_right": ["w"],
        "type_differs": ["z"],
    }


def test_membership_and_coverage(spark):
    base = spark.createDataFrame([("A",), ("A",), ("B",), ("C",), (None,)], "k string")
    one = spark.createDataFrame([("A",), ("A",), ("Z",), (None,)], "c string")
    two = spark.createDataFrame([("A",), ("B",)], "d string")
    flags = membership_flags(base, "k", {"in_one": (one, "c"), "in_two": (two, "d")})
    assert rows(flags) == [(None, 0, 0), ("A", 1, 1), ("B", 0, 1), ("C", 0, 0)]
    assert rows(coverage_totals(flags, ["in_one", "in_two"])) == [(4, 1, 2)]
    assert plan(flags).count("Exchange") == 1
    assert matched_rows(base, two.withColumnRenamed("d", "k"), "k").count() == 3


# ------------------------------------------------------------------- checks


def test_table_checks_and_enforce(spark):
    tables = {
        "good": spark.createDataFrame([(1, 1), (1, 2)], "a int, b int"),
        "repeated": spark.createDataFrame([(1, 1), (1, 1)], "a int, b int"),
        "null_key": spark.createDataFrame([(1, 1), (1, None)], "a int, b int"),
        "empty": spark.createDataFrame([], "a int, b int"),
    }
    report = table_checks(tables, {name: ["a", "b"] for name in tables})
    assert rows(report, "table_name", "row_count", "non_empty", "unique_key") == [
        ("empty", 0, False, True),
        ("good", 2, True, True),
        ("null_key", 2, True, False),
        ("repeated", 2, True, False),
    ]
    enforce(report.where("table_name = 'good'"), ["non_empty", "unique_key"])
    with pytest.raises(QualityError, match="empty"):
        enforce(report, ["non_empty"])
    with pytest.raises(QualityError, match="null_key"):
        enforce(report.where("table_name = 'null_key'"), ["unique_key"])


def test_reconcile(spark, trips):
    fact = rollup(trips, ["state"], {"total": F.count("*")})
    assert rows(reconcile(fact, "total", trips)) == [(6, 6, True)]
    assert rows(reconcile(fact.where("state = 'CA'"), "total", trips)) == [(3, 6, False)]
    assert rows(reconcile(fact.limit(0), "total", trips.limit(0))) == [(0, 0, True)]


def test_distinct_counts(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "x"), ("a", "y"), ("b", None)], "k string, v string"
    )
    assert rows(distinct_counts(df, ["k"], "v", "n")) == [("a", 2), ("b", 0)]


def test_reconcile_totals(spark, trips):
    fact = rollup(trips, ["state"], {"total": F.count("*")})
    report = reconcile_totals(
        {
            "whole": (fact, "total", trips),
            "part": (fact.where("state = 'CA'"), "total", trips),
            "nothing": (fact.limit(0), "total", trips.limit(0)),
        }
    )
    assert rows(report) == [("nothing", 0, 0, True), ("part", 3, 6, False), ("whole", 6, 6, True)]
    assert plan(report).count("Exchange") == 3  # the two facts, and the sums
    once = collected(report)
    assert "Scan parquet" not in plan(once) and rows(once) == rows(report)


def test_orphans(spark):
    fact = spark.createDataFrame(
        [(1, "a.b", 2), (1, "x", 2), (9, "x", 2), (None, "x", 2), (9, "y", 2)],
        "k int, `s.t` string, all int",
    )
    numbers = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    texts = spark.createDataFrame([("x",), ("y",), ("a.b",)], "`t.x` string")
    tables = {"fact": fact, "numbers": numbers, "texts": texts, "none": numbers.limit(0)}
    references = [
        Reference("fact", "k", "numbers", "id"),
        Reference("fact", "s.t", "texts", "t.x"),
        Reference("fact", "all", "none", "id"),
        Reference("none", "id", "numbers", "id"),
    ]
    report = orphans(tables, references)
    assert rows(report) == [
        ("fact", "all", "none", 5, 5, 1, False),
        ("fact", "k", "numbers", 5, 3, 2, False),
        ("fact", "s.t", "texts", 5, 0, 0, True),
        ("none", "id", "numbers", 0, 0, 0, True),
    ]


def test_names_with_dots_and_both_zeros(spark):
    df = spark.createDataFrame(
        [("a.", 0.0, 1), ("a.", -0.0, 2), (None, 1.5, 1), ("None", 1.5, 1)], "`k.x` string, `v.y` double, n int"
    )
    assert rows(value_counts(df, ["v.y"])) == [("v.y", "0.0", 2), ("v.y", "1.5", 2)]
    (profile,) = distinct_profile(df, ["v.y"]).collect()
    assert profile.distinct_count == 2
    assert clean_lookup(df).count() == 2
    assert rows(one_value_per_key(clean_lookup(df), "k.x", "n")) == [("a.", 1)]
    assert rows(unstable_keys(df, ["k.x"], ["n"])) == [("a.", 2)]
    assert attribute_variants(df, ["k.x"], ["n"]).count() == 4
    assert keep_first(df, ["k.x"], ["n"]).count() == 3
    assert rollup(df, ["k.x"], {"total": F.sum("n")}).count() == 3


def test_sketches_of_few_values_are_exact_also_merged(spark):
    values = [("a", float(v), v % 3) for v in range(100)] + [("b", -0.5, 0)]
    values += [("b", None, 1), ("b", math.nan, 1), ("c", None, 0)]
    df = spark.createDataFrame(values, "k string, `a.b` double, part int")
    parts = value_sketches(df, ["k", "part"], "a.b")
    assert {r["k"] for r in parts.collect()} == {"a", "b"}
    merged = merge_sketches(parts, ["k"], {"n_parts": F.count("*")})
    found = rows(
        merged.withColumn("median", sketch_quantile(0.5)),
        "k", "value_count", "total", "lowest", "highest", "n_parts", "median",
    )
    assert found == [("a", 100, 4950.0, 0.0, 99.0, 3, 49.0), ("b", 1, -0.5, -0.5, -0.5, 1, -0.5)]
    assert merge_sketches(parts.limit(0), ["k"]).count() == 0


def test_sketches_of_many_values_keep_their_rank_error(spark):
    """A key with most rows, in 20 parts of different ranges: the error in rank stays small."""
    n = 400_000
    df = spark.range(n).select(
        F.when(F.col("id") % 4 == 0, "small").otherwise("hot").alias("k"),
        F.col("id").cast("double").alias("v"),
        F.floor(F.col("id") * 20 / n).alias("part"),
    )
    merged = merge_sketches(value_sketches(df, ["k", "part"], "v"), ["k"])
    for rank in (0.01, 0.25, 0.5, 0.9):
        for found in merged.select(sketch_quantile(rank).alias("q")).collect():
            assert abs(found["q"] / n - rank) < 0.003
    text = plan(value_sketches(df, ["k"], "v"))
    assert "partial_kll_sketch_agg_double" in text and text.count("Exchange") == 1


@pytest.fixture
def shuffled_joins(spark):
    """No join is broadcast but those marked."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def skewed(spark, n=30_000):
    """A third of all rows have the key 7, a third have none, in eight tasks."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 1000)
    return spark.range(0, n, 1, 8).select("id", key.cast("int").alias("k"))


def test_hot_values(spark):
    df = skewed(spark).withColumn("other key.", F.lit("x")).withColumn("none", F.lit(None).cast("date"))
    found = hot_values(df, ["k", "other key.", "none"], 0.1)
    assert found == {"k": ["7"], "other key.": ["x"], "none": []}
    assert hot_values(df.limit(0), ["k"]) == {"k": []}
    assert hot_values(df, []) == {}


@pytest.mark.parametrize("how", ["left", "inner", "full"])
def test_hot_join_equals_the_plain_join(spark, how):
    df = skewed(spark, 3000).where("k IS NULL OR k < 500")
    lookup = spark.range(5, 600).select(F.col("id").cast("int").alias("k"), F.col("id").alias("label"))
    # keys without a row in the lookup, null keys on both sides
    lookup = lookup.unionByName(spark.sql("SELECT CAST(NULL AS INT) AS k, -1L AS label"))
    columns = ["id", "k", "label"]
    for hot in (["7"], ["7", "3"], []):
        got = join_hot(df, lookup, "k", hot, how)
        assert rows(got, *columns) == rows(df.join(lookup, "k", how), *columns)


def test_hot_rows_are_not_shuffled(spark, shuffled_joins, monkeypatch):
    from quaymart.operators import labels

    df = skewed(spark)
    lookup = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("l").alias("label"))
    small = codes(spark, ("1", "a")).withColumnRenamed("code", "c")
    lookups, types = {"k": lookup}, {}
    assert "SortMergeJoin" not in plan(join_labels(df, lookups, types))
    monkeypatch.setattr(labels, "MAX_BROADCAST_ROWS", 1000)
    # Both together are over the budget: the smaller one is broadcast, the other is not.
    both = join_labels(df.withColumn("c", F.lit("1")), {**lookups, "c": small}, types)
    text = plan(both)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" in text
    got = join_hot(df, lookup, "k", hot_values(df, ["k"], 0.1)["k"])
    text = plan(got)
    assert text.count("BroadcastHashJoin") == 1 and text.count("SortMergeJoin") == 1
    tasks = got.where("k = 7").groupBy(F.spark_partition_id().alias("task")).count()
    found = [n for (n,) in rows(tasks, "count")]
    assert len(found) == 8 and max(found) < 1300  # as they came, in all eight tasks
    assert both.count() == df.count()

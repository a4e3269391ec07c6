import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType

from quaymart.functions import (
    bucketize,
    calendar_columns,
    composite_key,
    date_to_epoch_day,
    epoch_day_to_date,
    last_token,
    parse_date,
    parse_timestamp,
    percentage,
    ratio,
    sequence_id,
    stable_id,
    standardize,
    strict_cast,
    to_number,
)
from quaymart.plans.arrivals import AGE_EDGES, AGE_LABELS, UNKNOWN_AGE
from tests.helpers import plan


def apply(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_last_token(spark):
    values = ["US-CA", "US-U-A", "US", "US- NY\t", "US-", "", None]
    got = apply(spark, values, "string", last_token)
    assert got == ["CA", "A", "US", "NY", "", "", None]


def test_epoch_day_to_date(spark):
    values = [0.0, -1.0, -0.5, 20454.0, 20454.9, None, math.nan, math.inf, 1e300]
    got = apply(spark, values, "double", epoch_day_to_date)
    assert got == [
        dt.date(1960, 1, 1),
        dt.date(1959, 12, 31),
        dt.date(1959, 12, 31),
        dt.date(2016, 1, 1),
        dt.date(2016, 1, 1),
        None,
        None,
        None,
        None,
    ]


def test_epoch_day_from_integer_and_back(spark):
    values = [-40000, -1, 0, 1, 20454, None]
    got = apply(
        spark, values, "int", lambda c: date_to_epoch_day(epoch_day_to_date(c))
    )
    assert got == [None if v is None else float(v) for v in values]


def test_calendar_columns(spark):
    sunday = dt.date(2016, 4, 3)
    df = spark.createDataFrame([(sunday,), (None,)], "d date")
    parts = calendar_columns(F.col("d"))
    first, empty = df.select(*[c.alias(n) for n, c in parts.items()]).collect()
    assert tuple(first) == (3, 4, 2016, "4-2016", 1)
    assert tuple(empty) == (None,) * 5


def age_category(age):
    if age is None or math.isnan(age) or age < 0 or age > 120:
        return UNKNOWN_AGE
    for upper, label in zip(AGE_EDGES[1:-1], AGE_LABELS):
        if age < upper:
            return label
    return AGE_LABELS[-1]


AGES = [None, math.nan, -1, -0.0, 0, 17, 17.9, 18, 29, 30, 39, 40, 49, 50, 59.5, 60]
AGES += [120, 120.1, 121, math.inf, -math.inf]


def buckets(spark, values):
    doubles = [None if v is None else float(v) for v in values]
    return apply(
        spark,
        doubles,
        "double",
        lambda c: bucketize(c, AGE_EDGES, AGE_LABELS, UNKNOWN_AGE),
    )


def test_bucketize_boundaries(spark):
    assert buckets(spark, AGES) == [
        age_category(None if a is None else float(a)) for a in AGES
    ]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-50, 200), min_size=1, max_size=60))
def test_bucketize_any_number(spark, values):
    assert buckets(spark, values) == [age_category(v) for v in values]


def test_bucketize_needs_matching_labels():
    with pytest.raises(ValueError):
        bucketize(None, [0, 1], ["a", "b"], "c")


def test_standardize(spark):
    got = apply(
        spark,
        ["M", "F", "m", "U", "", None],
        "string",
        lambda c: standardize(c, ["M", "F"], "O"),
    )
    assert got == ["M", "F", "O", "O", "O", "O"]


def test_composite_key(spark):
    df = spark.createDataFrame(
        [("M", "NORTH AMERICA", "18 to 29"), ("F", None, "Unknown")],
        "g string, c string, a string",
    )
    key = composite_key([F.col("g"), (F.col("c"), 3), (F.col("a"), 2)])
    assert [r[0] for r in df.select(key).collect()] == ["mnor18", None]


def test_ratio_and_percentage(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 2)], "a int, b int")
    got = df.select(
        ratio(F.col("a"), F.col("b")), percentage(F.col("a"), F.col("b"), 1)
    ).collect()
    assert [tuple(r) for r in got] == [(0.25, 25.0), (None, None), (None, None)]


def test_parsing(spark):
    assert apply(spark, ["2016-04-03", "x", None], "string", parse_date) == [
        dt.date(2016, 4, 3),
        None,
        None,
    ]
    assert apply(spark, ["2016-04-03 01:02:03", "x"], "string", parse_timestamp) == [
        dt.datetime(2016, 4, 3, 1, 2, 3),
        None,
    ]
    assert apply(spark, ["1.5", "x", None], "string", to_number) == [1.5, None, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_cast(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        small = apply(
            spark,
            [1, None],
            "bigint",
            lambda c: strict_cast(c, IntegerType(), False, "x"),
        )
        assert small == [1, None]
        with pytest.raises(PySparkException, match="cannot hold value 3000000000"):
            apply(
                spark,
                [3_000_000_000],
                "bigint",
                lambda c: strict_cast(c, IntegerType(), False, "x"),
            )
        with pytest.raises(PySparkException, match="null is not allowed"):
            apply(
                spark,
                [1, None],
                "bigint",
                lambda c: strict_cast(c, IntegerType(), True, "x"),
            )
        amount = apply(
            spark,
            [5.67891],
            "double",
            lambda c: strict_cast(c, DecimalType(18, 4), True, "x"),
        )
        assert str(amount[0]) == "5.6789"
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_ids(spark):
    df = spark.range(1000, numPartitions=4).select((F.col("id") % 10).alias("k"))
    assert df.select(sequence_id()).distinct().count() == 1000
    first = {r[0] for r in df.select(stable_id(["k"])).collect()}
    again = {r[0] for r in df.repartition(3).select(stable_id(["k"])).collect()}
    assert first == again and len(first) == 10


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("US-CA", 1.0)], "r string, d double")
    text = plan(
        df.select(
            last_token(F.col("r")),
            epoch_day_to_date(F.col("d")),
            bucketize(F.col("d"), AGE_EDGES, AGE_LABELS, UNKNOWN_AGE),
            standardize(F.col("r"), ["M"], "O"),
        )
    )
    assert "Python" not in text and "Batch" not in text.replace("Batched", "")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_cast_refuses_what_it_would_cut_off(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        cases = [
            ("3.7D", "int", None),
            ("3.0D", "int", "3"),
            ("TIMESTAMP'2020-01-02 13:45:00'", "date", None),
            ("TIMESTAMP'2020-01-02 00:00:00'", "date", "2020-01-02"),
        ]
        for value, kind, expected in cases:
            empty = spark.range(0).selectExpr(f"CAST(null AS {kind}) AS v")
            cast = strict_cast(F.expr(value), empty.schema["v"].dataType, False, "v")
            found = spark.range(1).select(cast.cast("string").alias("v"))
            if expected is None:
                with pytest.raises(Exception, match="cannot hold value"):
                    found.collect()
            else:
                assert found.first().v == expected
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)

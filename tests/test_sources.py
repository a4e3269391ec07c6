import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quaymart import schemas as S
from quaymart.functions import calendar_columns
from quaymart.sources import (
    conform,
    land,
    covers,
    load_table,
    monthly_paths,
    publish,
    UnreadableRows,
    publish_table,
    read_csv_checked,
    read_footers,
    schema_report,
    read_batches,
    read_csv,
    read_lookup,
    read_parquet,
    register_tables,
    staging_path,
    table_folders,
)
from tests.helpers import plan, rows


def files(path, ending):
    return [
        os.path.join(folder, name)
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(ending)
    ]


def test_read_lookup_is_text_with_quotes_and_empty_values(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text('code,label,place\n353,"TANZANIA, UNITED REPUBLIC OF",AFRICA\n1,,X\n')
    got = read_lookup(spark, str(path), ["code", "label", "place"])
    assert got.dtypes == [("code", "string"), ("label", "string"), ("place", "string")]
    assert rows(got) == [
        ("1", None, "X"),
        ("353", "TANZANIA, UNITED REPUBLIC OF", "AFRICA"),
    ]


def test_read_csv_modes(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("dt;v\n2016-04-03;1.5\n2016-04-04;\n")
    typed = read_csv(
        spark, str(path), "dt date, v double", sep=";", date_format="yyyy-MM-dd"
    )
    assert rows(typed) == [(dt.date(2016, 4, 3), 1.5), (dt.date(2016, 4, 4), None)]
    assert read_csv(spark, str(path), sep=";").dtypes == [
        ("dt", "string"),
        ("v", "string"),
    ]
    assert read_csv(spark, str(path), sep=";", infer=True).dtypes == [
        ("dt", "date"),
        ("v", "double"),
    ]


def test_a_header_in_another_order_is_refused(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("label,code\nAir,1\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_lookup(spark, str(path), ["code", "label"]).collect()
    good = read_lookup(spark, str(path), ["label", "code"])
    assert rows(good, "code") == [("1",)] and good.count() == 1


def test_monthly_paths():
    got = monthly_paths("Raw/2016/i94_%b%y_sub", dt.date(2015, 11, 1), dt.date(2016, 2, 9))
    assert got == [
        "Raw/2016/i94_nov15_sub",
        "Raw/2016/i94_dec15_sub",
        "Raw/2016/i94_jan16_sub",
        "Raw/2016/i94_feb16_sub",
    ]


def test_read_batches(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    land(spark.createDataFrame([(1, "x")], "n int, s string"), a)
    land(spark.createDataFrame([("y", 2, 0.5)], "s string, n int, d double"), b)
    same = read_batches(spark, [a, b], ["n", "s"])
    assert rows(same) == [(1, "x"), (2, "y")]
    drifted = read_batches(spark, [a, b], ["n", "d"], schemas_differ=True)
    assert rows(drifted) == [(1, None), (2, 0.5)]
    one_scan = read_batches(spark, [a, b], schema=drifted.schema)
    assert rows(one_scan) == [(1, None), (2, 0.5)]
    assert plan(one_scan).count("Scan") == plan(drifted).count("Scan") == 1
    with pytest.raises(ValueError):
        read_batches(spark, [])


def test_staging_is_below_the_shared_folder_and_fresh(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = staging_path(spark, "t"), staging_path(spark, "t")
    assert one.startswith(shared) and one != two


@pytest.fixture
def dated(spark):
    return spark.createDataFrame(
        [(1, dt.date(2016, 1, 5)), (2, dt.date(2016, 1, 6)), (3, dt.date(2016, 2, 1))],
        "n int, d date",
    )


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_publish_partitions_and_keeps_columns(spark, dated, tmp_path, file_format):
    path = str(tmp_path / "t")
    by_month = {"month_": "month(d)", "year_": "year(d)"}
    for _ in range(2):
        publish(dated, path, file_format, by_month)
    assert os.path.isdir(f"{path}/month_=1/year_=2016")
    reader = spark.read.format(file_format).option("header", True).schema(dated.schema)
    assert rows(reader.load(path).select("n", "d")) == rows(dated)


def test_refresh_of_partitions_leaves_the_others(spark, dated, tmp_path):
    path = str(tmp_path / "t")
    by_month = {"month_": "month(d)"}
    publish(dated, path, partition_by=by_month)
    january = spark.createDataFrame([(9, dt.date(2016, 1, 9))], "n int, d date")
    for _ in range(2):
        publish(january, path, partition_by=by_month, refresh="partitions")
    assert rows(read_parquet(spark, path, ["n"])) == [(3,), (9,)]
    publish(january, path, partition_by=by_month)
    assert rows(read_parquet(spark, path, ["n"])) == [(9,)]
    publish(january, path, partition_by=by_month, refresh="append")
    assert rows(read_parquet(spark, path, ["n"])) == [(9,), (9,)]


def test_publish_refuses_unknown_refresh(dated, tmp_path):
    with pytest.raises(ValueError):
        publish(dated, str(tmp_path / "t"), refresh="some")
    with pytest.raises(ValueError):
        publish(dated, str(tmp_path / "t"), refresh="partitions")


def test_rebalance_writes_few_files(spark, tmp_path):
    df = spark.range(10_000, numPartitions=8).withColumn("p", F.col("id") % 4)
    balanced, plain = str(tmp_path / "a"), str(tmp_path / "b")
    publish(df, balanced, partition_by=["p"])
    publish(df, plain, partition_by=["p"], rebalance=False)
    assert len(files(balanced, ".parquet")) <= 4 < len(files(plain, ".parquet"))


def test_conform_order_types_and_constraints(spark):
    df = spark.createDataFrame(
        [("CA", 5, 1.23456, "extra")], "state_name string, x int, y double, e string"
    ).withColumn("state_id", F.col("state_name"))
    got = conform(df, S.DIM_STATE.schema)
    assert got.columns == ["state_id", "state_name"]
    missing = df.withColumn("state_id", F.lit(None).cast("string"))
    with pytest.raises(PySparkException, match="column state_id: null"):
        conform(missing, S.DIM_STATE.schema).collect()


@pytest.fixture
def port_counts(spark):
    return spark.range(50, numPartitions=5).select(
        F.col("id").cast("string").alias("state_id"),
        F.lit("heliport").alias("port_type"),
        F.col("id").alias("num_of_ports"),
    )


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_publish_table_adds_unique_ids(spark, port_counts, tmp_path, file_format):
    for _ in range(2):
        table = publish_table(port_counts, S.FACT_PORTS, str(tmp_path), file_format)
    assert table.columns == S.FACT_PORTS.columns
    assert [f.dataType for f in table.schema.fields] == [
        f.dataType for f in S.FACT_PORTS.schema.fields
    ]
    assert table.count() == table.select("record_id").distinct().count() == 50
    assert rows(table, "state_id", "num_of_ports") == rows(
        port_counts, "state_id", "num_of_ports"
    )


def test_stable_ids_do_not_change(port_counts, tmp_path):
    ids = [
        rows(
            publish_table(df, S.FACT_PORTS, str(tmp_path / name), stable_ids=True),
            "state_id",
            "record_id",
        )
        for name, df in (("a", port_counts), ("b", port_counts.repartition(3)))
    ]
    assert ids[0] == ids[1]


def test_ids_are_given_after_the_last_shuffle(spark, tmp_path):
    """A sequence id below a shuffle could repeat when lost input is recomputed."""
    fact = spark.range(30).select(
        F.lit("CA").alias("state_id"),
        (1900 + F.col("id")).cast("int").alias("year"),
        *[
            F.lit(1).alias(c)
            for c in S.FACT_TEMPERATURE.columns
            if c not in ("record_id", "state_id", "year")
        ],
    )
    table = publish_table(fact, S.FACT_TEMPERATURE, str(tmp_path))
    assert table.select("record_id").distinct().count() == 30
    year = load_table(spark, S.FACT_TEMPERATURE, str(tmp_path), directories=["year_=1900"])
    assert len(year.inputFiles()) == 1 and rows(year, "year") == [(1900,)]
    folders = table_folders(spark, S.FACT_TEMPERATURE, str(tmp_path))
    assert len(folders) == 30 and all(os.path.isdir(f) for f in folders)


def test_register_tables(spark, port_counts, tmp_path):
    publish_table(port_counts, S.FACT_PORTS, str(tmp_path))
    register_tables(spark, str(tmp_path), names=["fact_ports"])
    total = spark.sql("SELECT sum(num_of_ports) AS n FROM fact_ports")
    assert rows(total) == [(sum(range(50)),)]
    assert load_table(spark, S.FACT_PORTS, str(tmp_path)).count() == 50


@pytest.mark.parametrize(
    ("path", "file", "expected"),
    [
        ("raw", "file:///x/raw/a.parquet", True),
        ("raw/", "file:///x/myraw/a.parquet", False),
        ("/x/raw", "file:///x/raw/a/b.parquet", True),
        ("/raw", "file:///x/raw/a.parquet", False),
        ("/x/r*/*.parquet", "s3://b/x/raw/a.parquet", True),
        ("/x/*.parquet", "file:///x/raw/a.parquet", False),
        ("s3://b/x", "s3://c/x/a.parquet", False),
        ("s3://b/x", "s3://b/x/a.parquet", True),
        ("file:/x/y z", "file:///x/y%20z/a.parquet", True),
        ("/x/a{1,2}.csv", "file:///x/a2.csv", True),
        ("/x/a[!1].csv", "file:///x/a1.csv", False),
        ("/x/a?.csv", "file:///x/a#.csv".replace("#", "%23"), True),
        ("/x/a.csv", "file:///x/abcsv", False),
    ],
)
def test_files_that_a_path_covers(path, file, expected):
    assert covers(path, file) is expected


def test_every_part_of_a_month_template_is_filled():
    months = monthly_paths("Raw/%Y/a_%b%y.parquet", dt.date(2016, 12, 1), dt.date(2017, 1, 1))
    assert months == ["Raw/2016/a_dec16.parquet", "Raw/2017/a_jan17.parquet"]


def test_unreadable_rows_are_kept_apart(spark, tmp_path):
    for name, lines in {"a": ["A;1;0.5", "B;abc;1", "C;;2"], "b": ["D;4", "E;5;6;7", "F;6;x"]}.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(["s;n;v", *lines]) + "\n")
    schema = spark.createDataFrame([], "s string, n int, v double").schema
    source = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    good, bad = read_csv_checked(spark, source, schema, f"{tmp_path}/landed", ";")
    assert rows(good) == [("A", 1, 0.5), ("C", None, 2.0)]
    found = [(os.path.basename(r.file), r.record) for r in bad.collect()]
    assert sorted(found) == [("a.csv", "B;abc;1"), ("b.csv", "D;4"), ("b.csv", "E;5;6;7"), ("b.csv", "F;6;x")]
    with pytest.raises(UnreadableRows, match="4 unreadable rows"):
        read_csv_checked(spark, source, schema, f"{tmp_path}/again", ";", most=3)
    read_csv_checked(spark, source, schema, f"{tmp_path}/again", ";", most=4)


def test_rows_outside_the_directories_to_replace(spark, tmp_path):
    days = spark.createDataFrame([(dt.date(2016, 1, 5),), (dt.date(2016, 2, 1),)], "timestamp date")
    table = days.select(
        "timestamp", *[c.alias(n) for n, c in calendar_columns(F.col("timestamp")).items()]
    )
    publish_table(table, S.DIM_DATETIME, str(tmp_path))
    january = ["month_=1/year_=2016"]
    with pytest.raises(ValueError, match="outside the directories"):
        publish_table(
            table, S.DIM_DATETIME, str(tmp_path), refresh="partitions", directories=january
        )
    none = table.where("month = 3")
    publish_table(none, S.DIM_DATETIME, str(tmp_path), refresh="partitions", directories=january)
    assert rows(load_table(spark, S.DIM_DATETIME, str(tmp_path)), "month") == [(2,)]


def drifting(spark, tmp_path, **parts):
    paths = []
    for name, query in parts.items():
        paths.append(str(tmp_path / name))
        spark.sql(query).write.parquet(paths[-1])
    return paths


def test_footers_are_compared(spark, tmp_path):
    paths = drifting(
        spark,
        tmp_path,
        a="SELECT 1 AS n, 'x' AS s",
        b="SELECT id AS N, array(id) AS more FROM range(0, 5, 1, 2)",
    )
    footers = land(read_footers(spark, paths), str(tmp_path / "footers"))
    assert footers.count() == 3
    found = rows(schema_report(footers).drop("data_types"))
    assert found == [("more", 2, 5, 1), ("n", 3, 6, 0), ("s", 1, 1, 5)]
    types = dict(rows(schema_report(footers), "column_name", "data_types"))
    assert types["n"] == "integer,long" and '"array"' in types["more"]


def test_files_without_stored_schema(spark, tmp_path):
    import pyarrow as pa
    from pyarrow import parquet as pq

    columns = {
        "u": pa.array([1, 2], pa.uint32()),
        "t": pa.array([0, 1], pa.timestamp("us")),
        "c": pa.array(["a", None]).dictionary_encode(),
    }
    pq.write_table(pa.table(columns), tmp_path / "own file%.parquet")
    paths = [str(tmp_path / "own file%.parquet")]
    report = schema_report(read_footers(spark, paths))
    assert rows(report, "column_name", "data_types") == [
        ("c", "string"),
        ("t", "timestamp_ntz"),
        ("u", "long"),
    ]
    assert rows(read_batches(spark, paths, ["u", "c"], schemas_differ=True)) == [(1, "a"), (2, None)]


def test_types_are_widened_in_one_scan(spark, tmp_path):
    paths = drifting(
        spark,
        tmp_path,
        a="SELECT 1Y AS n, 1.5F AS d, DATE '2020-01-02' AS t, 1.25BD AS m",
        b="SELECT 70000 AS n, 2.5D AS d, TIMESTAMP_NTZ '2020-01-03 04:00' AS t, 7 AS m",
        c="SELECT 5000000000 AS n, 3 AS d",
    )
    df = read_batches(spark, paths, schemas_differ=True)
    assert plan(df).count("FileScan") == 1
    assert [t for _, t in df.dtypes] == ["bigint", "double", "timestamp_ntz", "decimal(12,2)"]
    found = rows(df, "n", "d", "m")
    assert [r[:2] for r in found] == [(1, 1.5), (70000, 2.5), (5000000000, 3.0)]
    assert [r[2] and float(r[2]) for r in found] == [1.25, 7.0, None]
    assert rows(df.where("n > 1000000"), "n") == [(5000000000,)]
    assert rows(df.where("t > TIMESTAMP_NTZ '2020-01-02 01:00'"), "n") == [(70000,)]


def test_types_without_a_wider_one_take_a_scan_each(spark, tmp_path):
    paths = drifting(
        spark,
        tmp_path,
        a="SELECT 1 AS n, 'x' AS v",
        b="SELECT 2L AS n, 'y' AS v",
        c="SELECT 3 AS n, array(1) AS w",
        d="SELECT 4.5D AS n",
    )
    df = read_batches(spark, paths, schemas_differ=True, file_column="file")
    assert plan(df).count("FileScan") == 2
    assert rows(df, "n", "v") == [(1.0, "x"), (2.0, "y"), (3.0, None), (4.5, None)]
    assert [os.path.basename(os.path.dirname(f)) for n, f in rows(df, "n", "file")] == list("abcd")


def test_differing_files_below_partitions(spark, tmp_path):
    spark.sql("SELECT 1 AS n").write.parquet(str(tmp_path / "t/k=1"))
    spark.sql("SELECT 2L AS n, 'x' AS s").write.parquet(str(tmp_path / "t/k=2"))
    root = str(tmp_path / "t")
    df = read_batches(spark, [root], ["k", "n", "s"], schemas_differ=True, basePath=root)
    assert rows(df) == [(1, 1, None), (2, 2, "x")]

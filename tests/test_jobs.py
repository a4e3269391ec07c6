"""The jobs from files to published tables, against plain Python over the same rows."""

import datetime as dt
import math
import os
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quaymart import schemas as S
from quaymart.__main__ import main
from quaymart.operators import QualityError
from quaymart.plans import arrivals, temperature, warehouse
from quaymart.sources import find_version, land, load_table, publish_table, remove_old_versions
from tests import fixtures as X
from tests.helpers import plan, rows
from tests.test_functions import age_category


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    return warehouse.Paths(str(root / "stage"), str(root / "out"))


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """The input files; arrivals come as three files."""
    root = tmp_path_factory.mktemp("raw")
    texts = {
        "mode": X.MODES,
        "visa": X.VISAS,
        "port": X.PORT_LABELS,
        "citizenship": X.CITIZENSHIP_LABELS,
        "ports": X.PORT_REGISTER,
        "demographics": X.DEMOGRAPHICS,
        "temperature": X.TEMPERATURE_FILE,
    }
    for name, text in texts.items():
        (root / f"{name}.csv").write_text(text)
    found = {name: str(root / f"{name}.csv") for name in texts}
    made = X.arrivals()
    names = S.ARRIVALS.fieldNames()
    found["batches"] = []
    for i in range(3):
        part = [tuple(r[c] for c in names) for r in made[i::3]]
        path = str(root / f"arrivals_{i}")
        land(spark.createDataFrame(part, S.ARRIVALS).withColumn("extra", F.lit(1)), path)
        found["batches"].append(path)
    return found


@pytest.fixture(scope="module")
def built(spark, inputs, paths):
    """Everything built twice: a second run has to leave the same tables."""
    for _ in range(2):
        warehouse.prepare_arrivals(spark, inputs["batches"], inputs, paths)
        warehouse.build_arrivals(spark, paths)
        warehouse.build_ports(spark, inputs["ports"], paths)
        warehouse.build_demographics(spark, inputs["demographics"], paths)
        warehouse.build_temperature(spark, inputs["temperature"], paths)
    return paths


def table(spark, paths, contract):
    return load_table(spark, contract, paths.output)


def expected_arrivals():
    ports = {p[0]: p for p in X.PORTS}
    citizenships = {float(c[0]): c for c in X.CITIZENSHIPS}
    modes = {1.0: "Air", 2.0: "Sea", 3.0: "Land", 9.0: "Not Reported"}
    visas = {1.0: "Business", 2.0: "Pleasure", 3.0: "Student"}
    kept = []
    for row in X.arrivals():
        port, cit = ports.get(row["i94port"]), citizenships.get(row["i94cit"])
        day = row["arrdate"]
        if port is None or port[3] != "RELEVANT" or cit is None or cit[2] == "INVALID":
            continue
        if day is None or math.isnan(day):
            continue
        gender = row["gender"] if row["gender"] in ("M", "F") else "O"
        age = age_category(row["i94bir"])
        kept.append(
            {
                "state": port[2],
                "date": dt.date(1960, 1, 1) + dt.timedelta(days=math.floor(day)),
                "profile": (gender + cit[2][:3] + age[:2] + cit[3][:1]).lower(),
                "parts": (gender, age, cit[2], cit[3]),
                "mode": modes.get(row["i94mode"]),
                "visa": visas.get(row["i94visa"]),
            }
        )
    return kept


def test_arrivals_fact(spark, built):
    groups = defaultdict(Counter)
    for row in expected_arrivals():
        group = groups[row["state"], row["date"], row["profile"]]
        group.update(["all", row["mode"], row["visa"]])
    names = ["all", "Land", "Sea", "Air", "Business", "Pleasure", "Student"]
    expected = sorted(k + tuple(g[n] or None for n in names) for k, g in groups.items())
    fact = table(spark, built, S.FACT_IMMIGRATION)
    got = sorted(tuple(r)[1:] for r in fact.collect())
    assert got == expected and len(got) > 100
    report = warehouse.check_arrivals(spark, built)
    assert rows(report) == [("arrivals", len(expected_arrivals()), len(expected_arrivals()), True)]


def test_traveller_profiles(spark, built):
    expected = sorted({(r["profile"], *r["parts"]) for r in expected_arrivals()})
    assert rows(table(spark, built, S.DIM_TRAVELLER_PROFILE)) == expected


def test_calendar(spark, built):
    expected = sorted(
        (d, d.day, d.month, d.year, f"{d.month}-{d.year}", d.isoweekday() % 7 + 1)
        for d in {r["date"] for r in expected_arrivals()}
    )
    assert rows(table(spark, built, S.DIM_DATETIME)) == expected


def test_zero_filled_fact_and_range_of_days(spark, built):
    cleaned = warehouse.staged_arrivals(spark, built)
    fact = arrivals.arrivals_fact(cleaned, fill_zero=True)
    assert fact.where("land_travellers IS NULL").count() == 0
    day = dt.date(2016, 1, 1)
    one = arrivals.within(cleaned, day, day)
    assert one.count() == sum(r["date"] == day for r in expected_arrivals())
    assert "PushedFilters: [IsNotNull(" in plan(one)


def test_arrivals_from_text_files(spark, inputs, built, tmp_path):
    raw = spark.read.parquet(*inputs["batches"]).drop("extra")
    text = raw.withColumn("arrdate", F.nanvl("arrdate", F.lit(None).cast("double")))
    text.coalesce(2).write.option("header", True).csv(f"{tmp_path}/batch")
    paths = warehouse.Paths(f"{tmp_path}/stage", f"{tmp_path}/out")
    got = warehouse.prepare_arrivals(
        spark, [f"{tmp_path}/batch"], inputs, paths, "csv", rebalance=True
    )
    assert rows(arrivals.arrivals_fact(got)) == rows(
        arrivals.arrivals_fact(warehouse.staged_arrivals(spark, built))
    )


def parts(spark, paths, contract):
    return {p.part: p.folder for p in find_version(spark, f"{paths.output}/{contract.name}").parts}


ARRIVAL_TABLES = (S.FACT_IMMIGRATION, S.DIM_DATETIME, S.DIM_TRAVELLER_PROFILE)


def same_tables(spark, paths, others):
    for contract in ARRIVAL_TABLES:
        names = [c for c in contract.columns if c != "record_id"]
        assert rows(table(spark, paths, contract), *names) == rows(
            table(spark, others, contract), *names
        )
    warehouse.check_tables(spark, paths, [c.name for c in ARRIVAL_TABLES])
    warehouse.check_arrivals(spark, paths)


def test_a_new_month_is_added_without_reading_the_others(spark, inputs, built, tmp_path):
    """Days 20545.. are April 2016, the others January 2016 and around 1960."""
    paths = warehouse.Paths(f"{tmp_path}/stage", f"{tmp_path}/out")
    raw = spark.read.parquet(*inputs["batches"])
    land(raw.where("arrdate < 20500"), f"{tmp_path}/old")
    land(raw.where("arrdate >= 20500"), f"{tmp_path}/new")

    def prepare(batch, refresh):
        path = f"{tmp_path}/{batch}"
        warehouse.prepare_arrivals(spark, [path], inputs, paths, refresh=refresh)

    prepare("old", "all")
    warehouse.build_arrivals(spark, paths)
    before = parts(spark, paths, S.FACT_IMMIGRATION)
    ids = rows(table(spark, paths, S.FACT_IMMIGRATION), *S.FACT_IMMIGRATION.natural_key, "record_id")
    for _ in range(2):
        prepare("new", "batches")
        warehouse.build_arrivals(spark, paths, changes=True)
    after = parts(spark, paths, S.FACT_IMMIGRATION)
    assert before.items() <= after.items() and len(after) == len(before) + 1
    assert set(ids) <= set(
        rows(table(spark, paths, S.FACT_IMMIGRATION), *S.FACT_IMMIGRATION.natural_key, "record_id")
    )
    same_tables(spark, paths, built)
    # Only files with rows of the month are read for it.
    (april,) = set(after) - set(before)
    month = next(m for m in range(24_000, 24_300) if warehouse._directory(m) == april)
    read = warehouse.staged_arrivals(spark, paths, [month]).inputFiles()
    assert read and len(read) < len(warehouse.staged_arrivals(spark, paths).inputFiles())


def test_late_rows_join_their_month(spark, inputs, built, tmp_path):
    """The second file holds rows of a month that is there already, and is loaded twice."""
    paths = warehouse.Paths(f"{tmp_path}/stage", f"{tmp_path}/out")
    raw = spark.read.parquet(*inputs["batches"])
    late = F.coalesce(F.nanvl("arrdate", F.lit(None).cast("double")), F.lit(0)) % 2 == 1
    land(raw.where(~late), f"{tmp_path}/first file")
    land(raw.where(late), f"{tmp_path}/second")
    for batch, refresh in (("first file", "all"), ("second", "batches"), ("second", "batches")):
        path = f"{tmp_path}/{batch}"
        warehouse.prepare_arrivals(spark, [path], inputs, paths, refresh=refresh)
        warehouse.build_arrivals(spark, paths, changes=refresh == "batches")
        warehouse.check_arrivals(spark, paths)
    same_tables(spark, paths, built)


def test_a_glob_replaces_what_its_files_brought(spark, inputs, built, tmp_path):
    """Files written again under new names, and files of a glob refreshed one by one."""
    paths = warehouse.Paths(f"{tmp_path}/stage", f"{tmp_path}/out")
    raw = spark.read.parquet(*inputs["batches"])
    land(raw.where("arrdate < 20500"), f"{tmp_path}/old")
    land(raw.where("arrdate >= 20500"), f"{tmp_path}/new a")
    new = [f"{tmp_path}/new*/*.parquet"]
    warehouse.prepare_arrivals(spark, [f"{tmp_path}/old", *new], inputs, paths)
    warehouse.build_arrivals(spark, paths)
    n = warehouse.staged_arrivals(spark, paths).count()
    for again in (new, [f"{tmp_path}/new a"], [f"file:{tmp_path}/new [ab]/part-*.parquet"]):
        land(raw.where("arrdate >= 20500").repartition(3), f"{tmp_path}/new a")
        warehouse.prepare_arrivals(spark, again, inputs, paths, refresh="batches")
        assert warehouse.staged_arrivals(spark, paths).count() == n
        warehouse.build_arrivals(spark, paths, changes=True)
        same_tables(spark, paths, built)


def test_months_that_a_corrected_file_has_left(spark, inputs, built, tmp_path):
    """The second file is first loaded with all its rows in the wrong month, then corrected."""
    paths = warehouse.Paths(f"{tmp_path}/stage", f"{tmp_path}/out")
    raw = spark.read.parquet(*inputs["batches"])
    second = F.col("arrdate") >= 20500
    land(raw.where(~second), f"{tmp_path}/first")
    land(raw.where(second).withColumn("arrdate", F.lit(20700.0)), f"{tmp_path}/second")
    warehouse.prepare_arrivals(
        spark, [f"{tmp_path}/first", f"{tmp_path}/second"], inputs, paths
    )
    warehouse.build_arrivals(spark, paths)
    wrong = table(spark, paths, S.FACT_IMMIGRATION).where("arrival_date = DATE'2016-09-03'")
    assert wrong.count() > 0
    land(raw.where(second), f"{tmp_path}/second")
    warehouse.prepare_arrivals(
        spark, [f"{tmp_path}/second"], inputs, paths, refresh="batches"
    )
    # A second change before the build: both are made good.
    land(raw.where(~second), f"{tmp_path}/first")
    warehouse.prepare_arrivals(spark, [f"{tmp_path}/first"], inputs, paths, refresh="batches")
    warehouse.build_arrivals(spark, paths, changes=True)
    names = [c for c in S.FACT_IMMIGRATION.columns if c != "record_id"]
    for contract in (S.FACT_IMMIGRATION, S.DIM_DATETIME):
        names = [c for c in contract.columns if c != "record_id"]
        assert rows(table(spark, paths, contract), *names) == rows(
            table(spark, built, contract), *names
        )
    warehouse.check_arrivals(spark, paths)
    assert "month_=9/year_=2016" not in parts(spark, paths, S.FACT_IMMIGRATION)


def test_a_range_of_days_is_built_again(spark, inputs, built, tmp_path):
    paths = warehouse.Paths(built.staging, f"{tmp_path}/out")
    warehouse.build_arrivals(spark, paths)
    before = parts(spark, paths, S.FACT_IMMIGRATION)
    day = dt.date(2016, 1, 15)
    warehouse.build_arrivals(spark, paths, first=day, last=day)
    after = parts(spark, paths, S.FACT_IMMIGRATION)
    assert {p for p in after if after[p] != before[p]} == {"month_=1/year_=2016"}
    same_tables(spark, paths, built)
    only = warehouse.Paths(built.staging, f"{tmp_path}/only")
    warehouse.build_arrivals(spark, only, first=day, last=day)
    assert set(parts(spark, only, S.FACT_IMMIGRATION)) == {"month_=1/year_=2016"}


def test_ids_stay_over_refreshes_and_builds(spark, inputs, tmp_path):
    """Three refreshes and a build of everything; a key that left and returned has its old id."""
    paths = warehouse.Paths(f"{tmp_path}/stage", f"{tmp_path}/out")
    raw = spark.read.parquet(*inputs["batches"])
    land(raw.where("arrdate < 20500"), f"{tmp_path}/old")
    seen = {}
    for i, keep in enumerate(("true", "i94mode = 1", "true", "i94mode <> 1", "true")):
        land(raw.where(f"arrdate >= 20500 AND {keep}"), f"{tmp_path}/new")
        if i == 0:
            both = [f"{tmp_path}/old", f"{tmp_path}/new"]
            warehouse.prepare_arrivals(spark, both, inputs, paths)
        else:
            warehouse.prepare_arrivals(
                spark, [f"{tmp_path}/new"], inputs, paths, refresh="batches"
            )
        warehouse.build_arrivals(spark, paths, changes=0 < i < 4)
        fact = table(spark, paths, S.FACT_IMMIGRATION)
        now = {tuple(r)[1:]: r[0] for r in fact.select("record_id", *S.FACT_IMMIGRATION.natural_key).collect()}
        assert len(set(now.values())) == len(now) == fact.count()
        assert all(seen.get(k, v) == v for k, v in now.items())
        seen |= now
    assert len(set(seen.values())) == len(seen)


def test_a_write_that_fails_leaves_the_old_table(spark, built, tmp_path):
    states = table(spark, built, S.DIM_STATE)
    expected = rows(states)
    publish_table(states, S.DIM_STATE, str(tmp_path))
    bad = states.withColumn(
        "state_name",
        F.when(F.col("state_id") == "IA", F.raise_error(F.lit("lost"))).otherwise("x"),
    ).repartition(3)
    with pytest.raises(Exception, match="lost"):
        publish_table(bad, S.DIM_STATE, str(tmp_path))
    assert rows(load_table(spark, S.DIM_STATE, str(tmp_path))) == expected
    reader = load_table(spark, S.DIM_STATE, str(tmp_path))
    publish_table(states.limit(1), S.DIM_STATE, str(tmp_path))
    # A reader that began before sees the old version to its end.
    assert rows(reader) == expected
    assert load_table(spark, S.DIM_STATE, str(tmp_path)).count() == 1
    for _ in range(2):
        publish_table(states, S.DIM_STATE, str(tmp_path))
        assert rows(load_table(spark, S.DIM_STATE, str(tmp_path))) == expected
    removed = remove_old_versions(spark, f"{tmp_path}/dim_state", keep=1)
    assert len(removed) == 3
    assert rows(load_table(spark, S.DIM_STATE, str(tmp_path))) == expected


def test_two_writers_are_an_error(spark, built, tmp_path):
    states = table(spark, built, S.DIM_STATE)
    publish_table(states, S.DIM_STATE, str(tmp_path))
    log = f"{tmp_path}/dim_state/log"
    spark.read.parquet(log).write.mode("append").parquet(f"{tmp_path}/copy")
    spark.read.parquet(f"{tmp_path}/copy").write.mode("append").parquet(log)
    with pytest.raises(ValueError, match="two writers"):
        load_table(spark, S.DIM_STATE, str(tmp_path))


def test_labels_without_files(spark):
    assert rows(arrivals.mode_labels(spark), "i94mode_label") == [
        ("Air",),
        ("Land",),
        ("Not Reported",),
        ("Sea",),
    ]
    assert arrivals.visa_labels(spark).count() == 3


def test_ports(spark, built):
    fact = table(spark, built, S.FACT_PORTS)
    assert rows(fact, "state_id", "port_type", "num_of_ports") == [
        ("CA", "heliport", 1),
        ("CA", "small_airport", 2),
        ("MA", "heliport", 1),
        ("NY", "large_airport", 2),
        ("US", "large_airport", 1),
    ]
    assert rows(spark.read.parquet(built.port_cities)) == [
        ("CA", "None"),
        ("CA", "Quincy"),
        ("MA", "Quincy"),
        ("NY", None),
        ("NY", "New York"),
        ("US", "Bare"),
    ]


def test_demographics(spark, built):
    expected = {}
    for city in X.CITIES:
        state = expected.setdefault(city[9], defaultdict(int))
        for name, value in zip(
            ["male_pop", "female_pop", "total_pop", "veteran_pop", "foreign_pop"],
            city[3:8],
        ):
            state[name] += value or 0
        if city[8] and float(city[8]):
            state["total_hh"] += city[5] / float(city[8])
        for i, race in enumerate(city[10]):
            state[race] += 7 * i + len(city[0]) + city[3] % 5
    expected["IA"]["veteran_pop"] = None  # no city of the state states it
    got = {r["state_id"]: r for r in table(spark, built, S.FACT_DEMOGRAPHICS).collect()}
    assert set(got) == set(expected)
    columns = dict(zip(X.RACES, ["hispanic", "white", "asian", "black", "native"]))
    for state, want in expected.items():
        for name in ("male_pop", "female_pop", "total_pop", "veteran_pop", "foreign_pop"):
            assert got[state][name] == want[name], (state, name)
        for race, column in columns.items():
            assert got[state][f"{column}_pop"] == (want[race] or None)
        households = want["total_hh"]
        if not households:
            assert got[state]["total_hh"] is None and got[state]["avg_hh_size"] is None
            continue
        assert float(got[state]["total_hh"]) == pytest.approx(households, abs=1e-4)
        assert float(got[state]["avg_hh_size"]) == pytest.approx(
            want["total_pop"] / households, abs=1e-4
        )


def test_states_and_cities(spark, built):
    assert rows(table(spark, built, S.DIM_STATE)) == [
        ("CA", "California"),
        ("IA", "Iowa"),
        ("MA", "Massachusetts"),
    ]
    assert rows(spark.read.parquet(built.demographic_cities)) == sorted(
        {(c[0], c[1], c[9]) for c in X.CITIES}
    )


def test_temperature(spark, built):
    state_of = {"Boston": "MA", "Quincy": "CA", "New York": "NY"}
    groups = defaultdict(list)
    for day, value, city, country in X.temperatures():
        if country == "United States" and value is not None and city in state_of:
            groups[state_of[city], day.year].append((value, city))
    expected = []
    for (state, year), found in sorted(groups.items()):
        values = sorted(v for v, _ in found)
        figures = [
            values[0],
            values[-1],
            sum(values) / len(values),
            values[(len(values) - 1) // 2],
        ]
        expected.append(
            (state, year, len(values), len({c for _, c in found}))
            + tuple(Decimal(str(round(f, 4))).quantize(Decimal("0.0001")) for f in figures)
        )
    fact = table(spark, built, S.FACT_TEMPERATURE)
    assert sorted(tuple(r)[1:] for r in fact.collect()) == expected


def test_temperature_fact_shuffles_partial_results_only(spark, built):
    mapped = spark.read.parquet(f"{built.staging}/temperatures")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(temperature.temperature_fact(mapped))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one for the figures, two for the distinct cities, none for the join
    assert text.count("Exchange") == 3 and text.count("Join") == 1
    assert "Window" not in text and "Expand" not in text
    sketches = [line for line in text.splitlines() if "percentile_approx" in line]
    assert sketches and not any("City" in line for line in sketches)


def test_arrivals_fact_is_one_shuffle(spark, built):
    text = plan(arrivals.arrivals_fact(warehouse.staged_arrivals(spark, built)))
    assert text.count("Scan") == 1 and text.count("Exchange") == 1
    assert "Join" not in text and "Python" not in text
    columns = text.split("ReadSchema: struct<")[1].split(">")[0].split(",")
    assert len(columns) == 5


def test_checks_pass_and_fail(spark, built, tmp_path):
    report = warehouse.check_tables(spark, built)
    assert report.count() == 7 and report.where("NOT unique_key").count() == 0
    broken = warehouse.Paths(str(tmp_path), str(tmp_path))
    states = table(spark, built, S.DIM_STATE)
    land(states.unionByName(states), f"{tmp_path}/dim_state")
    with pytest.raises(QualityError, match="dim_state"):
        warehouse.check_tables(spark, broken, ["dim_state"])


def test_totals_and_references(spark, built):
    assert [r.reconciled for r in warehouse.check_totals(spark, built).collect()] == [True, True]
    report = {(r.fact_name, r.column_name): r for r in warehouse.check_references(spark, built).collect()}
    assert report["fact_immigration", "profile_id"].complete
    assert report["fact_immigration", "arrival_date"].orphan_rows == 0
    known = {r.state_id for r in table(spark, built, S.DIM_STATE).collect()}
    for contract in (S.FACT_IMMIGRATION, S.FACT_PORTS, S.FACT_TEMPERATURE):
        states = [r.state_id for r in table(spark, built, contract).collect()]
        found = report[contract.name, "state_id"]
        assert found.row_count == len(states)
        assert found.orphan_rows == sum(x not in known for x in states)
        assert found.orphan_keys == len(set(states) - known)
    with pytest.raises(QualityError, match="dim_state"):
        warehouse.check_references(spark, built, required=["dim_state"])


def test_traveller_share(spark, built):
    travellers = Counter(r["state"] for r in expected_arrivals())
    foreign = Counter()
    for city in X.CITIES:
        foreign[city[9]] += city[7]
    got = [tuple(r) for r in warehouse.traveller_share(spark, built).collect()]
    assert got == [
        (
            state,
            travellers[state],
            foreign[state],
            round(travellers[state] / sum(travellers.values()) * 100, 4),
            round(foreign[state] / sum(foreign.values()) * 100, 3),
        )
        for state, _ in foreign.most_common()
        if state in travellers
    ]


def test_csv_output_holds_the_same_rows(spark, built, tmp_path):
    as_csv = warehouse.Paths(built.staging, str(tmp_path), "csv")
    warehouse.build_arrivals(spark, as_csv)
    for contract in (S.FACT_IMMIGRATION, S.DIM_DATETIME, S.DIM_TRAVELLER_PROFILE):
        names = [c for c in contract.columns if c != "record_id"]
        assert rows(load_table(spark, contract, str(tmp_path), "csv"), *names) == rows(
            table(spark, built, contract), *names
        )


def test_command_line(spark, inputs, tmp_path, capsys):
    folders = ["--staging", f"{tmp_path}/s", "--output", f"{tmp_path}/o"]
    labels = [
        x
        for name in ("mode", "port", "visa", "citizenship")
        for x in (f"--{name}", inputs[name])
    ]
    main(["arrivals", *folders, *labels, "--batch", *inputs["batches"]])
    for job in ("ports", "demographics", "temperature"):
        main([job, *folders, "--input", inputs[job]])
    main(["arrivals", *folders, *labels, "--refresh", "batches", "--batch", *inputs["batches"]])
    main(["check", *folders])
    main(["share", *folders])
    main(["clean", *folders, "--keep", "1"])
    main(["check", *folders])
    shown = capsys.readouterr().out
    assert "fact_temperature" in shown and "state_traveller_perc" in shown


def temperature_text(found):
    lines = [
        f"{day},{'' if value is None else value},,{city},{country},,"
        for day, value, city, country in found
    ]
    return "\n".join([",".join(S.TEMPERATURES.fieldNames()), *lines]) + "\n"


def test_temperatures_are_refreshed_without_the_files_read_before(
    spark, built, inputs, tmp_path
):
    other = warehouse.Paths(built.staging, str(tmp_path / "out"))
    everything = sorted(X.temperatures(), key=lambda r: str(r[0]))
    half = len(everything) // 2
    first, second = tmp_path / "first.csv", tmp_path / "second.csv"
    first.write_text(temperature_text(everything[:half]))
    second.write_text(temperature_text(everything))  # to be corrected
    warehouse.refresh_temperature(spark, [str(first)], other, "all")
    warehouse.refresh_temperature(spark, [str(second)], other)
    first.unlink()
    second.write_text(temperature_text(everything[half:]))
    warehouse.refresh_temperature(spark, [str(second)], other)
    columns = [c for c in S.FACT_TEMPERATURE.schema.fieldNames() if c != S.FACT_TEMPERATURE.key]
    assert rows(table(spark, other, S.FACT_TEMPERATURE), *columns) == rows(
        table(spark, built, S.FACT_TEMPERATURE), *columns
    )
    with pytest.raises(ValueError, match="unknown refresh"):
        warehouse.refresh_temperature(spark, [str(second)], other, "some")
    # A file without one observation leaves nothing of what it had.
    second.write_text(temperature_text([]))
    warehouse.refresh_temperature(spark, [str(second)], other)
    left = rows(table(spark, other, S.FACT_TEMPERATURE), "observation_count")
    kept = [r for r in everything[:half] if r[1] is not None and r[3] == "United States"]
    assert 0 < sum(n for (n,) in left) <= len(kept)

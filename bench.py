"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores.
Every query is built and run in full twice, without keeping its rows; the better
time counts.  ``comparison`` sets the one-pass roll-ups against the same measures
computed one by one and joined back to the distinct keys.
"""

from __future__ import annotations

import contextlib
import io
import json
import os
import sys
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymart.catalog import QUERIES, jobs, lookups, registry
from quaymart.operators import (
    counts_by_category,
    join_measures,
    map_through,
    one_value_per_key,
    rollup,
)
from quaymart.plans import arrivals
from quaymart.session import get_session
from quaymart.sources import land, staging_path

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = [
    "share_of_total",
    "labelled_orders",
    "checked_labels",
    "arrivals_clean",
    "arrivals_fact",
    "traveller_profiles",
    "arrival_calendar",
    "ports_fact",
    "demographics_fact",
    "temperature_fact",
    "yearly_summary",
    "header_detail_rollup",
    "pivot_counts",
    "pivot_sums",
    "merged_lookup",
    "mapped_inner",
    "first_order_per_customer",
    "coverage_report",
    "distinct_profile",
    "value_counts",
    "null_profile",
    "unstable_lines",
    "unique_check",
    "conformed_orders",
    "multi_path_batch",
    "published_traveller_share",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(job: Callable[[], None], times: int = 2) -> float:
    taken = []
    for _ in range(times):
        start = time.perf_counter()
        job()
        taken.append(time.perf_counter() - start)
    return round(min(taken), 3)


def one_by_one(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    frames = [rollup(df, keys, {name: m}) for name, m in measures.items()]
    return join_measures(df.select(*keys).distinct(), frames, keys)


def exchanges(df: DataFrame) -> int:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return sum("Exchange " in line for line in text.getvalue().splitlines())


def compared(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]):
    forms = {"one_pass": rollup, "one_by_one": one_by_one}
    found = {}
    for name, form in forms.items():
        result = form(df, keys, measures)
        found[name] = {
            "exchanges": exchanges(result),
            "seconds": seconds(lambda: run(form(df, keys, measures))),
        }
    return found


def main() -> None:
    spark = get_session(
        "bench",
        spark__master=f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = registry.Tables(spark, FOLDER)
    run(tables.lineitem)  # start-up is not part of any query

    times = {
        name: seconds(lambda: run(QUERIES[name](spark, FOLDER))) for name in HEADLINES
    }

    cleaned = land(jobs.cleaned(tables), staging_path(spark, "cleaned"))
    mapped = map_through(
        tables.orders.select(
            F.col("o_custkey").alias("number"),
            F.col("o_totalprice").alias("price"),
            F.year("o_orderdate").alias("year"),
        ),
        land(
            one_value_per_key(lookups.pairs(tables), "number", "nation"),
            staging_path(spark, "lookup"),
        ),
        "number",
    )
    comparison = {
        "arrivals": compared(
            cleaned,
            ["i94port_state", "arrdateclean", "profile_id"],
            {
                "all_travellers": F.count("*"),
                **counts_by_category("i94mode_label", arrivals.MODE_COUNTS),
                **counts_by_category("i94visa_label", arrivals.VISA_COUNTS),
            },
        ),
        "temperature": compared(
            mapped,
            ["nation", "year"],
            {
                "observations": F.count("price"),
                "lowest": F.min("price"),
                "highest": F.max("price"),
                "mean": F.avg("price"),
                "median": F.percentile_approx("price", 0.5, 10_000),
            },
        ),
    }
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "comparison": comparison,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    sys.exit(main())

"""Run one job: ``python -m quaymart JOB --staging DIR --output DIR ...``

On a cluster, submit this file with the package in ``--py-files``.
The jobs ``ports`` and ``demographics`` come before ``temperature``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from quaymart.plans import warehouse
from quaymart.session import get_session


def parser() -> argparse.ArgumentParser:
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--staging", required=True, help="folder between jobs")
    shared.add_argument("--output", required=True, help="folder of published tables")
    shared.add_argument("--format", choices=["parquet", "csv"], default="parquet")

    top = argparse.ArgumentParser(prog="quaymart", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)
    arrivals = jobs.add_parser("arrivals", parents=[shared])
    arrivals.add_argument("--batch", nargs="+", required=True, help="monthly files")
    arrivals.add_argument("--batch-format", default="parquet")
    arrivals.add_argument("--refresh", choices=["all", "batches"])
    arrivals.add_argument("--rebalance", action="store_true", help="many small files")
    arrivals.add_argument("--schemas-differ", action="store_true", help="read file by file")
    for name in ("first", "last"):
        arrivals.add_argument(
            f"--{name}", type=date.fromisoformat, help=f"{name} day of the fact to replace"
        )
    for name in ("mode", "port", "visa", "citizenship"):
        arrivals.add_argument(f"--{name}", required=True, help=f"{name} labels, CSV")
    for name in ("ports", "demographics", "temperature"):
        job = jobs.add_parser(name, parents=[shared])
        job.add_argument("--input", required=True)
        if name == "demographics":
            job.add_argument("--most-unreadable", type=int, help="rows that may be left out")
        if name == "temperature":
            job.add_argument(
                "--refresh",
                choices=["all", "batches"],
                help="merge stored figures of files: start them anew, or add or replace the input",
            )
    jobs.add_parser("check", parents=[shared])
    jobs.add_parser("share", parents=[shared])
    clean = jobs.add_parser("clean", parents=[shared], help="delete old versions of tables")
    clean.add_argument("--keep", type=int, default=2, help="versions to keep")
    return top


def show_all(df: DataFrame) -> None:
    """Print every row, one at a time."""
    print(*df.columns, sep="\t")
    for row in df.toLocalIterator():
        print(*row, sep="\t")


def main(arguments: Sequence[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    if options.job == "arrivals":
        months = options.first is not None or options.last is not None
        if months and options.refresh == "all":
            parser().error("--first and --last keep other months, --refresh all does not")
        options.refresh = options.refresh or ("batches" if months else "all")
    spark = get_session(f"quaymart-{options.job}")
    paths = warehouse.Paths(options.staging, options.output, options.format)
    if options.job == "arrivals":
        labels = {
            name: getattr(options, name)
            for name in ("mode", "port", "visa", "citizenship")
        }
        warehouse.prepare_arrivals(
            spark,
            options.batch,
            labels,
            paths,
            options.batch_format,
            options.refresh,
            options.rebalance,
            options.schemas_differ,
        )
        warehouse.build_arrivals(
            spark,
            paths,
            options.first,
            options.last,
            options.refresh == "batches",
        )
    elif options.job == "ports":
        warehouse.build_ports(spark, options.input, paths)
    elif options.job == "demographics":
        most = options.most_unreadable
        unreadable = warehouse.build_demographics(spark, options.input, paths, most)
        show_all(unreadable.groupBy("file").count())
    elif options.job == "temperature":
        if options.refresh:
            warehouse.refresh_temperature(spark, [options.input], paths, options.refresh)
        else:
            warehouse.build_temperature(spark, options.input, paths)
    elif options.job == "check":
        for report in (
            warehouse.check_tables,
            warehouse.check_totals,
            warehouse.check_references,
        ):
            show_all(report(spark, paths))
    elif options.job == "clean":
        for folder in warehouse.remove_old(spark, paths, options.keep):
            print(folder)
    else:
        show_all(warehouse.traveller_share(spark, paths))


if __name__ == "__main__":
    main()

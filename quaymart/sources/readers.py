"""Table scans: CSV, Parquet and batches of files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date
from functools import reduce
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quaymart.sources.footers import read_footers, read_reconciled
from quaymart.sources.staging import staging_path


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    sep: str = ",",
    date_format: str | None = None,
    infer: bool = False,
) -> DataFrame:
    """CSV with a header row.

    Pass a schema wherever one is known: inference reads the whole input once
    more and may change type with the data, so it is for exploration.  With
    neither, every column is text.  A header that does not name the schema's
    columns in order is an error.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


class UnreadableRows(ValueError):
    """More rows of a file could not be read than are allowed."""


def read_csv_checked(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    landing: str,
    sep: str = ",",
    date_format: str | None = None,
    most: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV table that fit its schema, and ``file, record`` of those that don't.

    A value that is no number or date, or a missing or additional field, makes a row
    unreadable, where :func:`read_csv` would make the value null.  The text is parsed once,
    into Parquet at ``landing``; both results read that.  More than ``most`` unreadable
    rows are an error.
    """
    text, file = "_unreadable", "_file"
    full = StructType([*schema.fields, StructField(text, StringType())])
    reader = spark.read.options(header=True, sep=sep, enforceSchema=False)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    parsed = (
        reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=text)
        .schema(full)
        .csv(path)
        .withColumn(file, F.input_file_name())
    )
    rows = land(parsed, landing)
    bad = rows.where(F.col(text).isNotNull()).select(
        F.col(file).alias("file"), F.col(text).alias("record")
    )
    if most is not None and (n := bad.count()) > most:
        raise UnreadableRows(f"{n} unreadable rows in {path}, {most} allowed; see {landing}")
    return rows.where(F.col(text).isNull()).select(*schema.fieldNames()), bad


def read_lookup(
    spark: SparkSession, path: str, columns: Sequence[str], sep: str = ","
) -> DataFrame:
    """CSV code table with all columns as text, in a fixed column order."""
    schema = StructType([StructField(name, StringType()) for name in columns])
    return read_csv(spark, path, schema=schema, sep=sep)


def read_parquet(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] = ()
) -> DataFrame:
    """Parquet files or partitioned directories, optionally cut to some columns."""
    paths = [path] if isinstance(path, str) else path
    table = spark.read.parquet(*paths)
    return table.select(*columns) if columns else table


def _glob_pattern(glob: str) -> str:
    """A regular expression for the paths that a file glob names."""
    found, depth, i = [], 0, 0
    while i < len(glob):
        c = glob[i]
        if c == "\\" and i + 1 < len(glob):
            i += 1
            found.append(re.escape(glob[i]))
        elif c == "[" and "]" in glob[i + 2 :]:
            end = glob.index("]", i + 2)
            inner = glob[i + 1 : end].replace("\\", "\\\\")
            found.append("[^" + inner[1:] + "]" if inner[0] in "!^" else f"[{inner}]")
            i = end
        elif c in "{}" or (c == "," and depth):
            depth += {"{": 1, "}": -1, ",": 0}[c]
            found.append({"{": "(?:", "}": ")", ",": "|"}[c])
        else:
            found.append({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)))
        i += 1
    return "".join(found)


def covers(path: str, file: str) -> bool:
    """Whether a file, as ``input_file_name`` gives it, belongs to a path, folder or glob.

    A path without a scheme is that of any store, a relative one may stand below any
    folder; only whole parts of a path count.
    """
    parts, own = _uri(path), urlsplit(file)
    if parts[0] and (parts[0], parts[1]) != (own.scheme, own.netloc):
        return False
    glob = re.sub(r"(?<=.)/+$", "", parts[2])
    start = "" if glob.startswith("/") else "(?:.*/)?"
    inner = unquote(own.path)
    return re.fullmatch(f"{start}{_glob_pattern(glob)}(?:/.*)?", inner, re.DOTALL) is not None


def _uri(path: str) -> tuple[str, str, str]:
    """Scheme, host and path; what stands after ``?`` and ``#`` is part of the path."""
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(.*)", path, re.DOTALL)
    return (found[1], found[2] or "", found[3]) if found else ("", "", path)


def read_batches(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Sequence[str] = (),
    file_format: str = "parquet",
    schema: StructType | None = None,
    schemas_differ: bool = False,
    file_column: str | None = None,
    **options: str,
) -> DataFrame:
    """All files of a batch as one table, in one scan.

    Partition columns of the directories above the files are kept when the
    ``basePath`` option names the table root.

    Files whose columns differ are best read with a ``schema``: formats that store
    column names then fill the columns a file lacks with null, still in one scan.
    Without one, ``schemas_differ`` finds it: footers of Parquet files are read in tasks,
    columns matched by name and their types widened, for one scan of all files; types that
    no scan widens (number and text) take one scan a type.  Other formats are read path by
    path.

    ``file_column`` adds the file that a row comes from.
    """
    if not paths:
        raise ValueError("a batch needs at least one path")
    reader = spark.read.format(file_format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    named = {file_column: F.input_file_name()} if file_column else {}
    if schemas_differ and file_format == "parquet" and schema is None:
        footers = land(read_footers(spark, paths), staging_path(spark, "footers"))
        new_reader = lambda: spark.read.format(file_format).options(**options)
        table = read_reconciled(new_reader, footers, paths).withColumns(named)
    elif schemas_differ:
        table = reduce(
            lambda a, b: a.unionByName(b, allowMissingColumns=True),
            [reader.load(path).withColumns(named) for path in paths],
        )
    else:
        table = reader.load(list(paths)).withColumns(named)
    if columns:
        table = table.select(*columns, *named)
    return table


def monthly_paths(template: str, first: date, last: date) -> list[str]:
    """Paths of the months from ``first`` to ``last``, both included.

    The template is a ``strftime`` pattern filled with the first of each month,
    such as ``raw/%Y/arrivals_%b%y.parquet``; what is filled in, in any part of the path,
    is lower case as in the source, the rest stays as given.
    """
    start = first.year * 12 + first.month - 1
    end = last.year * 12 + last.month - 1
    months = [date(m // 12, m % 12 + 1, 1) for m in range(start, end + 1)]
    return [
        re.sub("%.", lambda part: month.strftime(part[0]).lower(), template)
        for month in months
    ]


def land(df: DataFrame, path: str) -> DataFrame:
    """Write a table as Parquet and read it back.

    For a raw source several results are built from: it is parsed once, later
    scans read only the columns they use, and the plan starts anew from files
    that outlive any executor.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)

"""What the operators share: texts, row keys, stored tables, free column names."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymart.sources import staging_path

# White space is ASCII white space throughout; a word is a run of anything else.
SPACE = r"[ \t-\r]+"
WORD = r"[^ \t-\r]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def show_package(spark: SparkSession) -> None:
    """Let Python workers on this machine find the package where the driver has it.

    Workers elsewhere get it as any library, for instance with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    show_package(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def text_or_empty(column: str | Column) -> Column:
    """A text column with null as the empty text."""
    column = F.col(quoted(column)) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(""))


def text_key(column: str | Column) -> Column:
    """64-bit hash of a text; with the id it names a row, for repeated and null ids."""
    return F.xxhash64(text_or_empty(column))


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def word_array(text: Column) -> Column:
    """The words of a text in order."""
    return F.array_remove(F.split(text, SPACE), "")


_BYTE_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def byte_words(text: bytes) -> list[bytes]:
    """Words of digits, letters and all beyond ASCII, A-Z in lower case, of UTF-8 text."""
    return _BYTE_WORD.findall(text.lower())  # bytes: A-Z alone are changed


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """``df.where(condition)`` over columns that are dear to compute.

    A filter is otherwise moved below the projection, and with it a second copy of
    what it looks at.  A filter on a row number cannot be moved.
    """
    (number,) = free_names(df, "number")
    numbered = df.withColumn(number, F.monotonically_increasing_id())
    return numbered.where(condition & (F.col(number) >= 0)).drop(number)


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until none is a column of ``df`` (in any case)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
    return found


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    It is computed once, the plan starts anew, and the files outlive any executor.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterable[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows, so that few results are held at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)

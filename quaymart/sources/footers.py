"""Schemas of Parquet files: read in tasks, compared, merged by widening."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)

FOOTERS = "file string, row_count long, fields string"


def read_footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``file, row_count, fields`` of every Parquet file below the paths.

    ``fields`` is the file's schema as JSON.  Spark lists the files and deals them over
    tasks, which read the footers alone, through the file systems ``pyarrow.fs`` knows.
    """

    # All that a worker needs is in here: it may not have this package.
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stated = b"org.apache.spark.sql.parquet.row.metadata"
        unsigned = {"uint8": "short", "uint16": "integer", "uint32": "long", "uint64": "decimal(20,0)"}

        def spark_type(kind: pa.DataType):
            if pa.types.is_dictionary(kind):
                kind = kind.value_type
            if str(kind) in unsigned:
                return unsigned[str(kind)]
            return from_arrow_type(kind, prefer_timestamp_ntz=True).jsonValue()

        def footer(path: str) -> tuple[str, int, str]:
            found = re.match(r"([a-z][a-z0-9+.-]*):/*", path)
            if found and found[1] != "file":
                # The store's name without the variant of its Hadoop client.
                store, inner = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
            else:
                store, inner = fs.LocalFileSystem(), "/" + path[found.end() :] if found else path
            with store.open_input_file(inner) as file:
                meta = pq.read_metadata(file)
            own = (meta.metadata or {}).get(stated)
            if own:
                return path, meta.num_rows, own.decode()
            fields = [
                {"name": f.name, "type": spark_type(f.type), "nullable": True, "metadata": {}}
                for f in meta.schema.to_arrow_schema()
            ]
            return path, meta.num_rows, json.dumps({"type": "struct", "fields": fields})

        for batch in batches:
            read = [footer(p) for p in batch.column(0).to_pylist()]
            columns = [pa.array([r[i] for r in read], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["file", "row_count", "fields"])

    kinds = [pa.string(), pa.int64(), pa.string()]
    # A listing of paths: the contents are not read.  A path named twice counts once.
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = listed.load(list(paths)).select("path").distinct()
    return files.mapInArrow(run, FOOTERS)


def schema_report(footers: DataFrame) -> DataFrame:
    """Columns of all files: the types they have and in how many files and rows they are.

    Returns ``column_name, data_types, file_count, row_count, missing_rows``; the types are
    sorted and joined by commas, ``missing_rows`` counts rows of files without the column.
    Names that differ in case alone are one column.  ``footers`` is read twice and should
    be stored.
    """
    parsed = F.from_json("fields", "fields array<struct<name string, type string>>")
    fields = footers.select("file", "row_count", F.inline(parsed["fields"]))
    by_column = fields.groupBy(F.lower("name").alias("column_name")).agg(
        F.array_join(F.sort_array(F.collect_set("type")), ",").alias("data_types"),
        F.count_distinct("file").alias("file_count"),
        F.sum("row_count").alias("row_count"),
    )
    total = footers.agg(F.sum("row_count")).scalar()
    return by_column.withColumn("missing_rows", total - F.col("row_count"))


_WHOLE = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}


def wider_type(a: DataType, b: DataType) -> DataType | None:
    """The smaller type that a Parquet scan reads both types as, without a loss; else None."""
    if a == b:
        return a
    kinds = {type(a), type(b)}
    if kinds <= _WHOLE.keys():
        return max(a, b, key=lambda t: _WHOLE[type(t)])
    if kinds == {FloatType, DoubleType} or (
        DoubleType in kinds and kinds & {ByteType, ShortType, IntegerType}
    ):
        return DoubleType()
    if kinds == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    if DecimalType in kinds and kinds <= {DecimalType, *_WHOLE}:
        digits = [
            (t.precision - t.scale, t.scale)
            if isinstance(t, DecimalType)
            else (10 if _WHOLE[type(t)] < 20 else 20, 0)
            for t in (a, b)
        ]
        whole, scale = map(max, zip(*digits, strict=True))
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def merge_schemas(a: StructType, b: StructType) -> StructType | None:
    """Columns of either schema, types widened; None if a column's types have none in common.

    Names are compared without case, as columns are found.
    """
    merged = {f.name.lower(): f for f in a}
    for field in b:
        known = merged.get(field.name.lower())
        kind = wider_type(known.dataType, field.dataType) if known else field.dataType
        if kind is None:
            return None
        merged[field.name.lower()] = StructField(known.name if known else field.name, kind)
    return StructType(list(merged.values()))


def schema_groups(footers: DataFrame) -> list[tuple[StructType, list[str] | None]]:
    """Schemas that together read all files, each with its files; None for all of them.

    The driver gets each different schema once.  One group is the rule; files are named
    only where the types of a column have no wider one in common.
    """
    different = footers.groupBy("fields").agg(F.min("file").alias("first")).collect()
    groups: list[tuple[StructType, list[str]]] = []
    for row in sorted(different, key=lambda r: r["first"]):
        schema = StructType.fromJson(json.loads(row["fields"]))
        for i, (known, texts) in enumerate(groups):
            merged = merge_schemas(known, schema)
            if merged is not None:
                groups[i] = merged, [*texts, row["fields"]]
                break
        else:
            groups.append((schema, [row["fields"]]))
    if len(groups) == 1:
        return [(groups[0][0], None)]
    return [
        (schema, [r["file"] for r in footers.where(F.col("fields").isin(texts)).select("file").collect()])
        for schema, texts in groups
    ]


def read_reconciled(reader_of, footers: DataFrame, paths: Sequence[str]) -> DataFrame:
    """The files as one table, one scan for each of :func:`schema_groups`.

    ``reader_of()`` gives a new reader with its format and options set.
    """
    scans = [
        reader_of().schema(schema).load(list(paths) if files is None else sorted(files))
        for schema, files in schema_groups(footers)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)

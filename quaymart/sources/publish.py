"""Typed, repeatable writes and the tables read back from them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quaymart.functions import sequence_id, stable_id, strict_cast
from quaymart.schemas import TABLES, Table
from quaymart.sources.versions import (
    Part,
    Version,
    commit,
    find_version,
    load_parts,
    new_folder,
    written_parts,
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns in order and cast each to its type.

    The query fails on a value that does not fit and on a null in a column the
    schema calls required.  Other columns of ``df`` are dropped.
    """
    return df.select(
        *[
            strict_cast(F.col(f.name), f.dataType, not f.nullable, f.name).alias(f.name)
            for f in schema.fields
        ]
    )


def publish(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    partition_by: Sequence[str] | Mapping[str, str] = (),
    refresh: str = "all",
    rebalance: bool = True,
    sequence: str | None = None,
    first: int = 0,
) -> str:
    """Write a table so that running it again leaves the same table.

    ``partition_by`` names directory columns, or maps new ones to the SQL
    expression that fills them.  Directory columns are not stored in the files,
    so a column that has to stay is mapped to a second name.

    ``refresh`` is ``all`` (replace the table), ``partitions`` (replace only the
    partitions that occur in ``df``; needs ``partition_by``, and ``df`` must hold
    all rows of those partitions) or ``append`` (add rows, not repeatable).

    ``rebalance`` shuffles a partitioned write so that each directory gets a few
    files of good size and a dominant one is split over many tasks.  Turn it off
    where the input already arrives ordered by partition.

    ``sequence`` names a column to put first and fill with unique ids from ``first`` on,
    in the stage that writes the files; where the column is there, only its nulls.
    """
    if refresh not in ("all", "partitions", "append"):
        raise ValueError(f"unknown refresh {refresh!r}")
    if refresh == "partitions" and not partition_by:
        raise ValueError("a refresh of partitions needs partition_by")
    if isinstance(partition_by, Mapping):
        df = df.withColumns({c: F.expr(e) for c, e in partition_by.items()})
    directories = list(partition_by)
    if directories and rebalance:
        df = df.hint("rebalance", *directories)
    if sequence:
        given = F.lit(first) + sequence_id()
        if sequence in df.columns:
            given = F.coalesce(sequence, given)
        others = [c for c in df.columns if c != sequence]
        df = df.select(given.alias(sequence), *others)
    writer = df.write.mode("append" if refresh == "append" else "overwrite")
    if directories:
        writer = writer.partitionBy(*directories).option(
            "partitionOverwriteMode", "dynamic" if refresh == "partitions" else "static"
        )
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)
    return path


def _keys(
    spark: SparkSession, table: Table, root: str, parts: Sequence[Part], file_format: str
) -> DataFrame:
    """Ids and natural keys of some directories of a table."""
    options = {"header": "true", "enforceSchema": "false"} if file_format == "csv" else {}
    rows = load_parts(spark, f"{root}/{table.name}", parts, table.schema, file_format, **options)
    return rows.select(table.key, *table.natural_key)


def _left_keys(spark: SparkSession, table: Table, root: str) -> tuple[str, Version | None]:
    """Where the keys are kept that have left the table, and their version."""
    path = f"{root}/keys/{table.name}"
    return path, find_version(spark, path)


def _keep_left_keys(old: DataFrame, new: DataFrame, table: Table, root: str) -> None:
    """Keep the ids of keys that a load takes out of the table: they may come back."""
    spark = old.sparkSession
    gone = old.join(new.select(*table.natural_key), list(table.natural_key), "left_anti")
    path, now = _left_keys(spark, table, root)
    folder = new_folder()
    publish(gone.select(*old.columns), f"{path}/{folder}")
    added = written_parts(spark, path, folder, False)
    if not load_parts(spark, path, added, old.schema).isEmpty():
        commit(spark, path, (*(now.parts if now else ()), *added), after=now)


def publish_table(
    df: DataFrame,
    table: Table,
    root: str,
    file_format: str = "parquet",
    refresh: str = "all",
    stable_ids: bool = False,
    directories: Iterable[str] | None = None,
    about: Mapping[str, str] | None = None,
) -> DataFrame:
    """Conform to the table's contract, write a new version below ``root`` and read it back.

    Readers see the old version until the new one is whole; a load that fails leaves the
    old one.  ``refresh`` is ``all`` (replace the table), ``partitions`` (replace those
    that occur in ``df``) or ``append`` (add rows).  ``directories`` names the partitions
    that ``df`` replaces, also those it has no rows for; rows elsewhere are an error then.

    A key that ``df`` lacks is a surrogate id and is added here.  A natural key keeps its id
    in every later load, also if it left the table and came back: ids are joined from the
    table itself (only ``directories`` of it) and from the few keys that have left it; new
    keys get ids beyond all given so far, in the stage that writes the files, so a lost
    executor cannot make two rows share one.  With ``stable_ids`` the id is a hash of the
    natural key instead.  ``about`` is kept with the version.
    """
    if refresh not in ("all", "partitions", "append"):
        raise ValueError(f"unknown refresh {refresh!r}")
    if refresh == "partitions" and not table.partitions:
        raise ValueError("a refresh of partitions needs partitions")
    spark = df.sparkSession
    path = f"{root}/{table.name}"
    now = find_version(spark, path)
    held = now.parts if now else ()
    only = None if directories is None else set(directories)
    touched = [p for p in held if only is None or p.part in only]
    sequence, first = None, 0
    if table.key in df.columns:
        rows = conform(df, table.schema)
    elif stable_ids:
        rows = conform(df.withColumn(table.key, stable_id(table.natural_key)), table.schema)
    else:
        sequence = table.key
        rows = conform(df, StructType([f for f in table.schema.fields if f.name != sequence]))
        if now:
            known = _keys(spark, table, root, touched, file_format)
            left, version = _left_keys(spark, table, root)
            if version:
                known = known.unionByName(load_parts(spark, left, version.parts, known.schema))
            rows = rows.join(known.distinct(), list(table.natural_key), "left")
            first = int(now.about.get("next_id", 0)) or _next_id(
                _keys(spark, table, root, held, file_format), sequence
            )
        rows = rows.select(*(c for c in table.columns if c in rows.columns))
    folder = new_folder()
    publish(
        rows, f"{path}/{folder}", file_format, table.partitions, sequence=sequence, first=first
    )
    added = written_parts(spark, path, folder, bool(table.partitions))
    if only is not None and (other := sorted({p.part for p in added} - only)):
        raise ValueError(f"rows outside the directories to replace: {other[:5]}")
    kept = held if refresh != "all" else ()
    if refresh == "partitions":
        gone = {p.part for p in added} | (only or set())
        kept = tuple(p for p in held if p.part not in gone)
    about = dict(about or {})
    if sequence:
        new = _keys(spark, table, root, added, file_format)
        about["next_id"] = str(max(first, _next_id(new, sequence)))
        replaced = [p for p in held if p not in kept]
        if replaced:
            _keep_left_keys(_keys(spark, table, root, replaced, file_format), new, table, root)
    commit(spark, path, (*kept, *added), about, now)
    return load_table(spark, table, root, file_format)


def _next_id(keys: DataFrame, name: str) -> int:
    last = keys.agg(F.max(name)).first()[0]
    return 0 if last is None else last + 1


def load_table(
    spark: SparkSession,
    table: Table,
    root: str,
    file_format: str = "parquet",
    directories: Iterable[str] | None = None,
) -> DataFrame:
    """A published table with its own columns and types, or just some of its directories.

    A folder of files without versions is read as it is.
    """
    path = f"{root}/{table.name}"
    options = {"header": "true", "enforceSchema": "false"} if file_format == "csv" else {}
    now = find_version(spark, path)
    if now is None:
        reader = spark.read.format(file_format).schema(table.schema).options(**options)
        return reader.load(path).select(*table.columns)
    wanted = None if directories is None else set(directories)
    parts = [p for p in now.parts if wanted is None or p.part in wanted]
    found = load_parts(spark, path, parts, table.schema, file_format, **options)
    return found.select(*table.columns)


def table_folders(spark: SparkSession, table: Table, root: str) -> list[str]:
    """The directories that hold the table now, for a bulk copy by another system."""
    now = find_version(spark, f"{root}/{table.name}")
    return [f"{root}/{table.name}/{p.path}" for p in now.parts] if now else []


def register_tables(
    spark: SparkSession,
    root: str,
    file_format: str = "parquet",
    names: Iterable[str] = tuple(TABLES),
) -> dict[str, DataFrame]:
    """Make published tables available to ``spark.sql`` under their own names."""
    loaded = {
        name: load_table(spark, TABLES[name], root, file_format) for name in names
    }
    for name, df in loaded.items():
        df.createOrReplaceTempView(name)
    return loaded

"""Tables that change in one step: readers see one finished version or another.

Data goes to a fresh folder below ``data``.  A version is one row of the small table
``log``, in a file of its own: it names every directory that belongs to the table, so what
a failed write left behind is never read and a refresh of some partitions copies nothing.
A table has one writer at a time; two that end at the same version are an error to readers.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quaymart.sources.staging import remove_folder

_LOG = (
    "version long, parts array<struct<part: string, folder: string, "
    "about: map<string, string>>>, about map<string, string>"
)


@dataclass(frozen=True)
class Part:
    """A directory of a table: its partition values as in its path, and where it lies."""

    part: str
    folder: str
    about: Mapping[str, str] = field(default_factory=dict)

    @property
    def path(self) -> str:
        return f"{self.folder}/{self.part}" if self.part else self.folder


@dataclass(frozen=True)
class Version:
    number: int
    parts: tuple[Part, ...] = ()
    about: Mapping[str, str] = field(default_factory=dict)


def find_version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The latest version of the table at ``path``, or that of a number; None without one."""
    try:
        log = spark.read.schema(_LOG).parquet(f"{path}/log")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if number is not None:
        log = log.where(F.col("version") == number)
    rows = log.orderBy(F.desc("version")).limit(2).collect()
    if not rows:
        return None
    if len(rows) == 2 and rows[0]["version"] == rows[1]["version"]:
        raise ValueError(f"two writers made version {rows[0]['version']} of {path}")
    return Version(
        rows[0]["version"],
        tuple(Part(p["part"], p["folder"], p["about"]) for p in rows[0]["parts"]),
        rows[0]["about"],
    )


def new_folder() -> str:
    """Where in a table the next data may go."""
    return f"data/{uuid.uuid4().hex}"


def written_parts(
    spark: SparkSession, path: str, folder: str, partitioned: bool
) -> tuple[Part, ...]:
    """The directories that a finished write made; a row for each is collected."""
    if not partitioned:
        return (Part("", folder),)
    part = F.regexp_extract("path", f"{folder}/(.+)/[^/]+$", 1)
    files = spark.read.format("binaryFile").load(f"{path}/{folder}")
    names = files.select(part.alias("part")).distinct().collect()
    return tuple(Part(r["part"], folder) for r in names)


def commit(
    spark: SparkSession,
    path: str,
    parts: Iterable[Part],
    about: Mapping[str, str] | None = None,
    after: Version | None = None,
) -> Version:
    """Make ``parts`` the table: the one step that readers notice."""
    version = Version(after.number + 1 if after else 1, tuple(parts), dict(about or {}))
    rows = [
        (version.number, [(p.part, p.folder, dict(p.about)) for p in version.parts], version.about)
    ]
    spark.createDataFrame(rows, _LOG).coalesce(1).write.mode("append").parquet(f"{path}/log")
    return version


def load_parts(
    spark: SparkSession,
    path: str,
    parts: Sequence[Part],
    schema: StructType | str | None = None,
    file_format: str = "parquet",
    **options: str,
) -> DataFrame:
    """The rows of some directories, without the columns that name directories."""
    if not parts:
        if schema is None:
            raise ValueError(f"no data at {path} and no schema")
        return spark.createDataFrame([], schema)
    reader = spark.read.format(file_format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load([f"{path}/{p.path}" for p in parts])


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete data that only versions before the last ``keep`` name; returns the folders.

    No reader may still be at those versions.
    """
    last = find_version(spark, path)
    if last is None:
        return []
    log = spark.read.schema(_LOG).parquet(f"{path}/log")
    folders = log.select("version", F.explode("parts").alias("p")).groupBy("p.folder").agg(
        F.max("version").alias("last")
    )
    old = [r["folder"] for r in folders.where(F.col("last") <= last.number - keep).collect()]
    for folder in old:
        remove_folder(f"{path}/{folder}")
    return sorted(old)

"""Where intermediate tables go."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, below the shared checkpoint folder.

    The folder is the one the session names in ``spark.checkpoint.dir``, or the
    context's checkpoint folder.  Only a local session that names neither gets a
    temporary folder; on a cluster other machines could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a shared folder")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="quaymart-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/quaymart/{uuid.uuid4().hex}/{name}"


def remove_folder(path: str) -> None:
    """Delete a folder and all in it, given by a path or a URI; none there is no error."""
    found = re.match(r"([a-z][a-z0-9+.-]*):/*", path)
    if found and found[1] != "file":
        store, inner = fs.FileSystem.from_uri(path)
    else:
        store, inner = fs.LocalFileSystem(), "/" + path[found.end() :] if found else path
    if store.get_file_info(inner).type == fs.FileType.Directory:
        store.delete_dir(inner)


def remove_staging(spark: SparkSession) -> None:
    """Delete all intermediate tables; no query may still read them."""
    remove_folder(staging_path(spark, "").rsplit("/", 2)[0])

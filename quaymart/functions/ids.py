"""Surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sequence_id() -> Column:
    """A bigint id per row, unique by construction at any size.

    It depends on the order of rows in a task, so it differs from run to run and
    belongs in the last stage before a write: a shuffle above it whose lost input
    is computed again could see one id on two rows.
    """
    return F.monotonically_increasing_id()


def stable_id(natural_key: Sequence[str]) -> Column:
    """A bigint id hashed from the natural key, the same in every run.

    Refreshing some partitions of a table needs it.  A 64-bit hash is expected
    to collide once a table nears 10**9 rows; the unique-key check then fails the
    load rather than let two rows share an id.
    """
    return F.xxhash64(*natural_key)

"""String expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\f\v"


def last_token(col: Column, separator: str = "-") -> Column:
    """Text after the last separator, without surrounding blanks.

    A value without the separator is returned whole; null stays null.
    """
    return F.btrim(F.substring_index(col, separator, -1), F.lit(BLANKS))


def composite_key(parts: Sequence[Column | tuple[Column, int]]) -> Column:
    """Lower-cased concatenation of the parts, each cut to its length if given.

    One null part makes the key null, so a key never hides a missing attribute.
    """
    pieces = [
        F.substring(part[0], 1, part[1]) if isinstance(part, tuple) else part
        for part in parts
    ]
    return F.lower(F.concat(*pieces))


def quoted(name: str) -> str:
    """A column name as ``F.col`` takes it whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"

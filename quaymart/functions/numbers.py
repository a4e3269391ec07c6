"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in double precision; a zero denominator gives null, not an error."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percentage(part: Column, total: Column, digits: int = 2) -> Column:
    """Part of a total in percent."""
    return F.round(ratio(part, total) * F.lit(100.0), digits)


def to_number(col: Column) -> Column:
    """Text to double; text that is no number becomes null."""
    return col.try_cast("double")


def strict_cast(col: Column, data_type: DataType, required: bool, name: str) -> Column:
    """Cast for a typed load: fail on a value the type cannot hold.

    A fraction does not fit a whole number, nor a time of day a date; rounding to a
    decimal's scale is not a loss.  ``required`` also fails on null.  The tests run inside the projection, so a
    load needs no extra pass, and they hold with ANSI mode on or off.
    """
    cast = col.try_cast(data_type)
    lost = col.isNotNull() & cast.isNull()
    wider = {IntegralType: "decimal(38,18)", DateType: "timestamp"}
    for kind, name_of_wider in wider.items():
        if isinstance(data_type, kind):
            changed = col.try_cast(name_of_wider) != cast.cast(name_of_wider)
            lost = lost | F.coalesce(changed, F.lit(False))
    problem = F.concat(
        F.lit(f"column {name}: cannot hold value "), col.cast("string")
    )
    checked = F.when(lost, F.raise_error(problem).cast(data_type))
    if required:
        absent = F.raise_error(F.lit(f"column {name}: null is not allowed"))
        checked = checked.when(col.isNull(), absent.cast(data_type))
    return checked.otherwise(cast)

"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SAS_EPOCH = "1960-01-01"


def epoch_day_to_date(col: Column, epoch: str = SAS_EPOCH) -> Column:
    """Numeric day count from ``epoch`` (may be negative) to a date.

    Part days round down, also before the epoch.  NaN and day counts outside the
    integer range become null; without the guard a NaN would silently be day 0.
    """
    day = col.cast("double")
    whole = F.floor(day).try_cast("int")
    return F.when(~F.isnan(day), F.date_add(F.to_date(F.lit(epoch)), whole))


def date_to_epoch_day(col: Column, epoch: str = SAS_EPOCH) -> Column:
    """Days from ``epoch`` to a date, as the double the source files hold."""
    return F.date_diff(col.cast("date"), F.to_date(F.lit(epoch))).cast("double")


def month_year_label(col: Column) -> Column:
    """``month-year`` without zero padding, e.g. ``4-2016``."""
    return F.concat(
        F.month(col).cast("string"), F.lit("-"), F.year(col).cast("string")
    )


def calendar_columns(col: Column) -> dict[str, Column]:
    """Parts of a date by name; days of the week run 1 (Sunday) to 7."""
    return {
        "day": F.dayofmonth(col),
        "month": F.month(col),
        "year": F.year(col),
        "month_year": month_year_label(col),
        "day_of_week": F.dayofweek(col),
    }


def parse_date(col: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Text to date; text that is no date becomes null instead of an error."""
    return F.try_to_timestamp(col, F.lit(pattern)).cast("date")


def parse_timestamp(col: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to timestamp; text that is no timestamp becomes null."""
    return F.try_to_timestamp(col, F.lit(pattern))

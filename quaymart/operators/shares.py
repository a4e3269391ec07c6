"""Share-of-total measures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymart.functions import percentage


def share_of_total(
    df: DataFrame, shares: Mapping[str, tuple[str | Column, int]]
) -> DataFrame:
    """Add each measure's percentage of its total over the whole table.

    ``shares`` maps a new column to ``(measure, digits)``.  The totals are one
    scalar subquery, computed by partial sums.  A window over everything would
    move all rows into one task.
    """
    totals = df.agg(
        F.struct(*[F.sum(m).alias(name) for name, (m, _) in shares.items()])
    ).scalar()
    return df.withColumns(
        {
            name: percentage(
                F.col(m) if isinstance(m, str) else m, totals.getField(name), digits
            )
            for name, (m, digits) in shares.items()
        }
    )

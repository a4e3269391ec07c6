"""Column expressions.  All native, so they stay inside whole-stage codegen."""

from quaymart.functions.buckets import bucketize, standardize
from quaymart.functions.dates import (
    calendar_columns,
    date_to_epoch_day,
    epoch_day_to_date,
    month_year_label,
    parse_date,
    parse_timestamp,
)
from quaymart.functions.ids import sequence_id, stable_id
from quaymart.functions.numbers import percentage, ratio, strict_cast, to_number
from quaymart.functions.text import composite_key, last_token, quoted

__all__ = [
    "bucketize",
    "calendar_columns",
    "composite_key",
    "date_to_epoch_day",
    "epoch_day_to_date",
    "last_token",
    "month_year_label",
    "parse_date",
    "parse_timestamp",
    "percentage",
    "quoted",
    "ratio",
    "sequence_id",
    "stable_id",
    "standardize",
    "strict_cast",
    "to_number",
]

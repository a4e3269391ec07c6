"""Table-level operators."""

from quaymart.operators.checks import (
    QualityError,
    Reference,
    collected,
    enforce,
    orphans,
    reconcile,
    reconcile_totals,
    table_checks,
)
from quaymart.operators.labels import (
    InvalidLookup,
    broadcast_if_small,
    hot_values,
    join_hot,
    join_labels,
    prepare_lookups,
    with_labels,
)
from quaymart.operators.lookups import (
    ambiguous_keys,
    clean_lookup,
    keep_first,
    map_through,
    merge_lookups,
    one_value_per_key,
)
from quaymart.operators.profiling import (
    attribute_variants,
    column_info,
    coverage_totals,
    distinct_profile,
    matched_rows,
    membership_flags,
    null_profile,
    numeric_summary,
    schema_difference,
    span,
    unstable_keys,
    value_counts,
)
from quaymart.operators.rollup import (
    counts_by_category,
    distinct_counts,
    header_detail_rollup,
    join_measures,
    rollup,
    sums_by_category,
)
from quaymart.operators.shares import share_of_total
from quaymart.operators.sketches import (
    SKETCH_SIZE,
    merge_sketches,
    sketch_quantile,
    value_sketches,
)
from quaymart.operators.wide_profile import wide_profile

__all__ = [
    "InvalidLookup",
    "QualityError",
    "Reference",
    "SKETCH_SIZE",
    "ambiguous_keys",
    "attribute_variants",
    "broadcast_if_small",
    "clean_lookup",
    "collected",
    "column_info",
    "counts_by_category",
    "coverage_totals",
    "distinct_counts",
    "distinct_profile",
    "enforce",
    "header_detail_rollup",
    "hot_values",
    "join_hot",
    "join_labels",
    "join_measures",
    "keep_first",
    "map_through",
    "matched_rows",
    "membership_flags",
    "merge_lookups",
    "merge_sketches",
    "null_profile",
    "numeric_summary",
    "one_value_per_key",
    "orphans",
    "prepare_lookups",
    "reconcile",
    "reconcile_totals",
    "rollup",
    "schema_difference",
    "share_of_total",
    "sketch_quantile",
    "span",
    "sums_by_category",
    "table_checks",
    "unstable_keys",
    "value_counts",
    "value_sketches",
    "wide_profile",
    "with_labels",
]

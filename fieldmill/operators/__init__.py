from fieldmill.operators.compare import bucket_digests, frame_difference, table_difference, unequal_buckets
from fieldmill.operators.groups import (
    distinct_counts,
    distinct_values,
    group_stats,
    mode_per_group,
    order_split,
    ratio_where,
    top_k,
    top_per_group,
)
from fieldmill.operators.headers import clean_header, lower_names, sort_columns, trim_strings
from fieldmill.operators.lookups import left_join_many, lookup_roles
from fieldmill.operators.nested import (
    array_positions,
    array_to_columns,
    flatten_struct,
    positions_to_columns,
    prefix_columns,
)
from fieldmill.operators.nulls import cast_columns, drop_all_null_columns, na_to_null
from fieldmill.operators.quality import expect_or_drop, expectation_report, require_shape
from fieldmill.operators.sketches import distinct_sketches, hashed_sample, merge_sketches, sketched_counts

__all__ = [
    "array_positions",
    "array_to_columns",
    "bucket_digests",
    "cast_columns",
    "clean_header",
    "distinct_counts",
    "distinct_sketches",
    "distinct_values",
    "drop_all_null_columns",
    "expect_or_drop",
    "expectation_report",
    "flatten_struct",
    "frame_difference",
    "group_stats",
    "hashed_sample",
    "left_join_many",
    "lookup_roles",
    "lower_names",
    "merge_sketches",
    "mode_per_group",
    "na_to_null",
    "order_split",
    "positions_to_columns",
    "prefix_columns",
    "ratio_where",
    "require_shape",
    "sketched_counts",
    "sort_columns",
    "table_difference",
    "top_k",
    "top_per_group",
    "trim_strings",
    "unequal_buckets",
]

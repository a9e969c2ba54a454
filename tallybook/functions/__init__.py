from tallybook.functions.columns import (
    all_equal,
    any_differs,
    as_list,
    classify,
    first_entry,
    is_current,
    json_properties,
    last_entry,
    ordered_sum,
    prop,
    props,
    recency,
    recency_step,
)

__all__ = [
    "all_equal",
    "any_differs",
    "as_list",
    "classify",
    "first_entry",
    "is_current",
    "json_properties",
    "last_entry",
    "ordered_sum",
    "prop",
    "props",
    "recency",
    "recency_step",
]

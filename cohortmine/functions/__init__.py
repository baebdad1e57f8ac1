"""Column expressions shared by the operators (all built-in, JVM-side)."""

from cohortmine.functions.columns import (
    half_up_milli,
    itemset_string,
    java_trim,
    milli_to_double,
    parse_itemset_string,
    reference_count,
    subset_by_mask,
    support_passes,
)

__all__ = [
    "half_up_milli",
    "itemset_string",
    "java_trim",
    "milli_to_double",
    "parse_itemset_string",
    "reference_count",
    "subset_by_mask",
    "support_passes",
]

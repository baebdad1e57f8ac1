"""Sources and sinks: driver Parquet tables, stand-in mappings and text formats."""

from cohortmine.sources.line_format import register as register_line_format
from cohortmine.sources.stored import (
    open_measurements,
    store_measurements,
    stored_baskets,
    stored_label_counts,
    stored_transactions,
)
from cohortmine.sources.tables import (
    TABLES,
    m1_measurements,
    m1_subjects,
    m2_measurements,
    m2_subjects,
    read_table,
)
from cohortmine.sources.text_io import (
    itemset_lines,
    label_count_lines,
    parse_basket_lines,
    parse_itemset_lines,
    parse_measurement_lines,
    parse_subject_lines,
    read_baskets_text,
    read_itemsets_text,
    read_lines,
    read_measurements_csv,
    read_subjects_text,
    report_lines,
    rule_lines,
    split_measurement_lines,
    split_subject_lines,
    write_itemsets_parquet,
    write_itemsets_text,
    write_label_counts_text,
    write_rules_text,
    write_support_report_text,
)

__all__ = [
    "TABLES",
    "itemset_lines",
    "label_count_lines",
    "m1_measurements",
    "m1_subjects",
    "m2_measurements",
    "m2_subjects",
    "open_measurements",
    "parse_basket_lines",
    "parse_itemset_lines",
    "parse_measurement_lines",
    "parse_subject_lines",
    "read_baskets_text",
    "read_itemsets_text",
    "read_lines",
    "read_measurements_csv",
    "read_subjects_text",
    "read_table",
    "register_line_format",
    "report_lines",
    "rule_lines",
    "split_measurement_lines",
    "split_subject_lines",
    "store_measurements",
    "stored_baskets",
    "stored_label_counts",
    "stored_transactions",
    "write_itemsets_parquet",
    "write_itemsets_text",
    "write_label_counts_text",
    "write_rules_text",
    "write_support_report_text",
]

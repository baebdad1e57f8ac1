"""cohortmine: cohort profiling, frequent-itemset mining and association rules on Spark.

Every operator is a DataFrame plan built from ``pyspark.sql.functions``; Catalyst and
AQE choose the physical strategy. The public API is re-exported here.
"""

from cohortmine.operators.baskets import (
    baskets,
    cohort_measurements,
    transaction_count,
    transactions,
)
from cohortmine.operators.border import sampled_itemsets, stored_itemsets, update_itemsets
from cohortmine.operators.cohort import (
    cohort,
    explode_labels,
    label_counts,
    strong_measurements,
    subject_labels,
)
from cohortmine.operators.condensed import closed_itemsets, maximal_itemsets, supports_from_closed
from cohortmine.operators.fpgrowth import fp_itemsets, fp_model, fp_rules
from cohortmine.operators.itemsets import (
    candidates,
    cooccurring_pairs,
    frequent_itemsets,
    frequent_pairs,
    item_counts,
    mine_itemsets,
)
from cohortmine.operators.rules import (
    association_rules,
    expand_subsets,
    grown_rules,
    rule_complement,
    support_report,
)
from cohortmine.operators.text import total_text_length

__all__ = [
    "association_rules",
    "baskets",
    "candidates",
    "closed_itemsets",
    "cohort",
    "cohort_measurements",
    "cooccurring_pairs",
    "expand_subsets",
    "explode_labels",
    "fp_itemsets",
    "fp_model",
    "fp_rules",
    "frequent_itemsets",
    "frequent_pairs",
    "grown_rules",
    "item_counts",
    "label_counts",
    "maximal_itemsets",
    "mine_itemsets",
    "rule_complement",
    "sampled_itemsets",
    "stored_itemsets",
    "strong_measurements",
    "subject_labels",
    "support_report",
    "supports_from_closed",
    "total_text_length",
    "transaction_count",
    "transactions",
    "update_itemsets",
]

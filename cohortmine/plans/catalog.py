"""Registered queries on the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables.
Itemsets leave as ``'a;b;'`` strings and counts as BIGINT so results compare
value-for-value with the SQL in :mod:`cohortmine.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmine.functions import itemset_string
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
from cohortmine.operators.fpgrowth import fp_itemsets, fp_rules
from cohortmine.operators.condensed import closed_itemsets, maximal_itemsets, supports_from_closed
from cohortmine.operators.itemsets import (
    cooccurring_pairs,
    frequent_pairs,
    item_counts,
    least_count,
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
from cohortmine.session import ensure_checkpoint_dir
from cohortmine.sources import line_format, stored
from cohortmine.sources.tables import (
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
    report_lines,
    rule_lines,
)

# Fixed parameters of the two mappings.
M1_LABELS = ("BUILDING", "MACHINERY", "HOUSEHOLD")
M1_MIN_VALUE = 40000.0
M1_SPARSE_MIN_VALUE = 100000.0
M2_LABELS = ("blue", "hot", "ring", "bolt", "gear")
M2_FEATURE = 4
M2_MIN_VALUE = 40000.0
MIN_SUPPORT = 0.3
REFERENCE_MIN_SUPPORT = 0.1
MIN_CONFIDENCE = 0.6
# The dense setting: size 3 and beyond hold rows at every scale factor.
DENSE_MIN_VALUE = 20000.0
DENSE_MIN_SUPPORT = 0.2
DENSE_MAX_SIZE = 3
ROWS_MIN_SUPPORT = 0.35
SPARSE_MIN_SUPPORT = 0.003

Query = Callable[[SparkSession, str], DataFrame]


# ---- M1 building blocks -------------------------------------------------------

def m1_cohort(spark: SparkSession, sf: str) -> DataFrame:
    return cohort(m1_subjects(spark, sf), M1_LABELS)


def m1_transactions(spark: SparkSession, sf: str, min_value: float = M1_MIN_VALUE) -> DataFrame:
    return transactions(m1_measurements(spark, sf), m1_cohort(spark, sf), min_value)


def m1_itemsets(spark: SparkSession, sf: str, max_size: int | None = 3,
                min_support: float = MIN_SUPPORT, count_mode: str = "exact",
                min_value: float = M1_MIN_VALUE, method: str = "bitmap") -> tuple[DataFrame, int]:
    """Mined itemsets (items, k, cnt) and n for mapping M1."""
    return mine_itemsets(m1_transactions(spark, sf, min_value), min_support, max_size=max_size,
                         count_mode=count_mode, method=method)


def supplier_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """(tid, item) = (customer, supplier) of its orders: short baskets over many items."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", F.col("l_suppkey").cast("int").alias("item"))
    orders = read_table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("tid"))
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select("tid", "item").distinct()


def _strings(df: DataFrame, *cols: str) -> DataFrame:
    """Replace the named array columns by their ``'a;b;'`` text."""
    return df.select(*[itemset_string(c).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---- queries --------------------------------------------------------------------

def q_label_explode(spark, sf):
    return explode_labels(m2_subjects(spark, sf), M2_LABELS)


def q_label_counts(spark, sf):
    return label_counts(m2_subjects(spark, sf), m2_measurements(spark, sf), M2_LABELS,
                        M2_FEATURE, M2_MIN_VALUE)


def q_subject_labels(spark, sf):
    return subject_labels(m2_subjects(spark, sf), M2_LABELS)


def q_strong_measurements(spark, sf):
    return strong_measurements(m2_measurements(spark, sf), M2_FEATURE, M2_MIN_VALUE)


def q_cohort_subjects(spark, sf):
    return m1_cohort(spark, sf)


def q_cohort_measurements(spark, sf):
    return cohort_measurements(m1_measurements(spark, sf), m1_cohort(spark, sf), M1_MIN_VALUE)


def q_transactions(spark, sf):
    return m1_transactions(spark, sf)


def q_baskets(spark, sf):
    return _strings(baskets(m1_transactions(spark, sf)), "items")


def q_transaction_count(spark, sf):
    return transaction_count(m1_transactions(spark, sf))


def q_transaction_count_sparse(spark, sf):
    return transaction_count(m1_transactions(spark, sf, M1_SPARSE_MIN_VALUE))


def q_item_support(spark, sf):
    its, _ = m1_itemsets(spark, sf, max_size=1)
    return its.select(F.element_at("items", 1).alias("item"), "cnt")


def q_item_row_counts(spark, sf):
    rows = cohort_measurements(m1_measurements(spark, sf), m1_cohort(spark, sf), M1_MIN_VALUE)
    return item_counts(rows, rows=True, tid="subject_id", item="feature_id")


def q_candidate_pairs(spark, sf):
    """The candidates of size 2 that occur at all: pairs of frequent items in one transaction."""
    tx = m1_transactions(spark, sf).checkpoint()  # read three times: the sources are joined once
    its, _ = mine_itemsets(tx, MIN_SUPPORT, max_size=1)
    frequent = its.select(F.element_at("items", 1).alias("item"))
    return _strings(cooccurring_pairs(tx.join(frequent, "item", "left_semi")), "items")


def q_pairs_hashed(spark, sf):
    """Frequent pairs of the sparse baskets: each customer's suppliers, pair slots counted first."""
    tx = supplier_transactions(spark, sf).checkpoint()
    n = tx.select("tid").distinct().count()
    return _strings(frequent_pairs(tx, least_count(n, SPARSE_MIN_SUPPORT)), "items")


def q_itemsets_low_support(spark, sf):
    """Many items at a low support: sorted tid lists instead of 4 KiB bitmaps."""
    its, _ = mine_itemsets(supplier_transactions(spark, sf), SPARSE_MIN_SUPPORT, max_size=2, method="vertical")
    return _strings(its, "items")


def q_itemsets_vertical(spark, sf):
    return _strings(_dense(spark, sf, "vertical")[0], "items")


def q_itemsets_partition(spark, sf):
    return _strings(_dense(spark, sf, "partition")[0], "items")


def q_itemsets_sampled(spark, sf):
    """The dense setting by a sample of its transactions, verified with the negative border."""
    tx = m1_transactions(spark, sf, DENSE_MIN_VALUE)
    return _strings(sampled_itemsets(tx, DENSE_MIN_SUPPORT, DENSE_MAX_SIZE)[0], "items")


def q_itemsets_incremental(spark, sf):
    """The dense setting taken in three batches; most transactions arrive in pieces."""
    tx = m1_transactions(spark, sf, DENSE_MIN_VALUE).checkpoint()
    state = f"{ensure_checkpoint_dir(spark)}/itemsets-{uuid.uuid4().hex}"
    for b in range(3):
        part = tx.filter(F.pmod(F.xxhash64("tid", "item"), F.lit(3)) == b)
        update_itemsets(state, part, b, DENSE_MIN_SUPPORT, DENSE_MAX_SIZE)
    return _strings(stored_itemsets(spark, state)[0], "items")


def q_closed_itemsets(spark, sf):
    return _strings(closed_itemsets(_dense(spark, sf, "partition")[0]), "items")


def q_maximal_itemsets(spark, sf):
    return _strings(maximal_itemsets(_dense(spark, sf, "partition")[0]), "items")


def q_itemsets_from_closed(spark, sf):
    """The dense result condensed to its closed itemsets and rebuilt from them."""
    return _strings(supports_from_closed(closed_itemsets(_dense(spark, sf, "partition")[0])), "items")


def q_rules_grown(spark, sf):
    return _strings(grown_rules(_dense(spark, sf, "partition")[0], min_confidence=MIN_CONFIDENCE, k=3, ordered=True),
                    "antecedent", "consequent")


def q_itemsets_pairs(spark, sf):
    its, _ = m1_itemsets(spark, sf, max_size=2)
    return _strings(its.filter("k = 2").select("items", "cnt"), "items")


def q_itemsets_triples(spark, sf):
    its, _ = m1_itemsets(spark, sf, max_size=3)
    return _strings(its.filter("k = 3").select("items", "cnt"), "items")


def q_itemsets_all(spark, sf):
    its, _ = m1_itemsets(spark, sf, max_size=3)
    return _strings(its.orderBy("k", F.desc("cnt"), "items"), "items")


def q_itemsets_tidjoin(spark, sf):
    its, _ = m1_itemsets(spark, sf, max_size=3, method="tidjoin")
    return _strings(its, "items")


def q_itemsets_reference_counts(spark, sf):
    its, _ = m1_itemsets(spark, sf, max_size=3, min_support=REFERENCE_MIN_SUPPORT,
                         count_mode="reference")
    return _strings(its, "items")


def q_itemsets_fpgrowth(spark, sf):
    its, _ = m1_itemsets(spark, sf, max_size=3, method="fpgrowth")
    return _strings(its, "items")


def q_itemsets_reference_rows(spark, sf):
    """Reference counting from undeduplicated rows: single items count rows (D3)."""
    rows = cohort_measurements(m1_measurements(spark, sf), m1_cohort(spark, sf), DENSE_MIN_VALUE)
    its, _ = mine_itemsets(rows, ROWS_MIN_SUPPORT, max_size=2, count_mode="reference",
                           tid="subject_id", item="feature_id")
    return _strings(its, "items")


def _dense(spark, sf, method="bitmap"):
    return m1_itemsets(spark, sf, max_size=DENSE_MAX_SIZE, min_support=DENSE_MIN_SUPPORT,
                       min_value=DENSE_MIN_VALUE, method=method)


def q_itemsets_dense(spark, sf):
    return _strings(_dense(spark, sf)[0], "items")


def q_itemsets_dense_fpgrowth(spark, sf):
    return _strings(_dense(spark, sf, "fpgrowth")[0], "items")


def q_report_dense(spark, sf):
    its, n = _dense(spark, sf)
    return _strings(support_report(its, n, k=3), "items")


def q_rules_dense(spark, sf):
    its, _ = _dense(spark, sf)
    return _strings(association_rules(its, min_confidence=MIN_CONFIDENCE, k=3, ordered=True),
                    "antecedent", "consequent")


def q_support_report(spark, sf):
    its, n = m1_itemsets(spark, sf, max_size=3)
    return _strings(support_report(its, n, k=3), "items")


def q_itemset_subsets(spark, sf):
    its, _ = m1_itemsets(spark, sf, max_size=3)
    sub = expand_subsets(its.filter("k = 3"))
    return _strings(sub.select("items", F.col("antecedent").alias("subset"), "cnt"),
                    "items", "subset")


def q_rule_complement(spark, sf):
    its, _ = m1_itemsets(spark, sf, max_size=3)
    rc = rule_complement(its.filter("k = 3"), its)
    return _strings(rc.select("antecedent", "consequent", "cnt", "ante_cnt"),
                    "antecedent", "consequent")


def q_association_rules(spark, sf):
    its, _ = m1_itemsets(spark, sf, max_size=3)
    rules = association_rules(its, min_confidence=MIN_CONFIDENCE, k=3)
    return _strings(rules.orderBy(F.desc("confidence"), "antecedent", "consequent"),
                    "antecedent", "consequent")


def m1_baskets(spark: SparkSession, sf: str) -> DataFrame:
    return baskets(m1_transactions(spark, sf))


def q_fp_itemsets(spark, sf):
    return _strings(fp_itemsets(m1_baskets(spark, sf), MIN_SUPPORT, strict=True), "items")


def q_fp_rules(spark, sf):
    rules = fp_rules(m1_baskets(spark, sf), MIN_SUPPORT, MIN_CONFIDENCE)
    return _strings(rules, "antecedent", "consequent")


# ---- text formats: lines built from table columns, parsed or written by the library -----

def q_measurement_lines_parsed(spark, sf):
    """S1 + P2: lineitem rows as measurement lines, with the header among them."""
    m = m2_measurements(spark, sf)
    lines = m.select(F.concat_ws(",", F.col("subject_id").cast("string"), F.col("feature_id").cast("string"),
                                 F.col("value").cast("string")).alias("value"))
    header = m.limit(1).select(F.lit("patientid,geneid,expression_value").alias("value"))
    return parse_measurement_lines(header.unionByName(lines))


def q_subject_lines_parsed(spark, sf):
    """S2 + P2: customers as ragged subject lines (every third has one field more)."""
    c = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    key = F.col("c_custkey").cast("string")
    lines = c.select(F.concat_ws(",", key, F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")),
                                 F.col("c_mktsegment"), key).alias("value"))
    header = c.limit(1).select(F.lit("id,labels,last").alias("value"))
    return parse_subject_lines(header.unionByName(lines))


def _line_files(spark: SparkSession, df: DataFrame, kind: str) -> str:
    """``df`` written as line files by the registered format, in a new shared folder."""
    path = f"{ensure_checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    df.write.format(line_format.register(spark)).option("kind", kind).mode("append").save(path)
    return path


def q_measurement_lines_source(spark, sf):
    """S1 + P2 as a data source: lineitem rows written as line files and read back."""
    path = _line_files(spark, m2_measurements(spark, sf), "measurements")
    return spark.read.format(line_format.NAME).option("kind", "measurements").load(path)


def q_itemset_lines_source(spark, sf):
    """S3 + K2/K3 as a data source: mined itemsets written as line files and read back."""
    path = _line_files(spark, _dense(spark, sf, "partition")[0], "itemsets")
    return _strings(spark.read.format(line_format.NAME).option("kind", "itemsets").load(path), "items")


def _stored_m1(spark: SparkSession, sf: str, measurements=m1_measurements) -> stored.StoredMeasurements:
    path = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    return stored.store_measurements(measurements(spark, sf), path)


def q_transactions_stored(spark, sf):
    """J2 + H3 over measurements bucketed by subject."""
    return stored.stored_transactions(_stored_m1(spark, sf), m1_cohort(spark, sf), M1_MIN_VALUE)


def q_baskets_stored(spark, sf):
    """A3 over measurements bucketed by subject."""
    return _strings(stored.stored_baskets(_stored_m1(spark, sf), m1_cohort(spark, sf), M1_MIN_VALUE), "items")


def q_label_counts_stored(spark, sf):
    """J1 + A1 over measurements bucketed by subject."""
    return stored.stored_label_counts(_stored_m1(spark, sf, m2_measurements), m2_subjects(spark, sf), M2_LABELS,
                                      M2_FEATURE, M2_MIN_VALUE)


def q_label_count_lines(spark, sf):
    return label_count_lines(q_label_counts(spark, sf))


def q_itemset_lines(spark, sf):
    return itemset_lines(_dense(spark, sf)[0])


def q_itemset_lines_parsed(spark, sf):
    """S3 + P4: the lines of K2/K3 read back; a second comma field is not read."""
    lines = itemset_lines(_dense(spark, sf)[0]).select(F.concat("value", F.lit(" ,9;")).alias("value"))
    return _strings(parse_itemset_lines(lines), "items")


def q_report_lines(spark, sf):
    its, n = _dense(spark, sf)
    return report_lines(support_report(its, n, k=3))


def q_rule_lines(spark, sf):
    its, _ = _dense(spark, sf)
    return rule_lines(association_rules(its, min_confidence=MIN_CONFIDENCE, k=3))


def q_basket_lines_parsed(spark, sf):
    """Part names as basket lines of words."""
    lines = read_table(spark, sf, "part").select(F.col("p_name").alias("value"))
    return parse_basket_lines(lines).select(F.concat_ws(" ", F.array_sort("items")).alias("items"))


def q_total_text_length(spark, sf):
    return total_text_length(read_table(spark, sf, "documents"), "text", split_lines=True)


QUERIES: dict[str, Query] = {
    "label_explode": q_label_explode,
    "label_counts": q_label_counts,
    "subject_labels": q_subject_labels,
    "strong_measurements": q_strong_measurements,
    "cohort_subjects": q_cohort_subjects,
    "cohort_measurements": q_cohort_measurements,
    "transactions": q_transactions,
    "baskets": q_baskets,
    "transaction_count": q_transaction_count,
    "transaction_count_sparse": q_transaction_count_sparse,
    "item_support": q_item_support,
    "item_row_counts": q_item_row_counts,
    "candidate_pairs": q_candidate_pairs,
    "itemsets_pairs": q_itemsets_pairs,
    "itemsets_triples": q_itemsets_triples,
    "itemsets_all": q_itemsets_all,
    "itemsets_tidjoin": q_itemsets_tidjoin,
    "itemsets_reference_counts": q_itemsets_reference_counts,
    "itemsets_fpgrowth": q_itemsets_fpgrowth,
    "itemsets_reference_rows": q_itemsets_reference_rows,
    "itemsets_dense": q_itemsets_dense,
    "itemsets_dense_fpgrowth": q_itemsets_dense_fpgrowth,
    "itemsets_vertical": q_itemsets_vertical,
    "itemsets_partition": q_itemsets_partition,
    "itemsets_sampled": q_itemsets_sampled,
    "itemsets_incremental": q_itemsets_incremental,
    "itemsets_low_support": q_itemsets_low_support,
    "pairs_hashed": q_pairs_hashed,
    "closed_itemsets": q_closed_itemsets,
    "maximal_itemsets": q_maximal_itemsets,
    "itemsets_from_closed": q_itemsets_from_closed,
    "rules_grown": q_rules_grown,
    "report_dense": q_report_dense,
    "rules_dense": q_rules_dense,
    "support_report": q_support_report,
    "itemset_subsets": q_itemset_subsets,
    "rule_complement": q_rule_complement,
    "association_rules": q_association_rules,
    "fp_itemsets": q_fp_itemsets,
    "fp_rules": q_fp_rules,
    "measurement_lines_parsed": q_measurement_lines_parsed,
    "subject_lines_parsed": q_subject_lines_parsed,
    "measurement_lines_source": q_measurement_lines_source,
    "itemset_lines_source": q_itemset_lines_source,
    "transactions_stored": q_transactions_stored,
    "baskets_stored": q_baskets_stored,
    "label_counts_stored": q_label_counts_stored,
    "label_count_lines": q_label_count_lines,
    "itemset_lines": q_itemset_lines,
    "itemset_lines_parsed": q_itemset_lines_parsed,
    "report_lines": q_report_lines,
    "rule_lines": q_rule_lines,
    "basket_lines_parsed": q_basket_lines_parsed,
    "total_text_length": q_total_text_length,
}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions -> frequent itemsets (<= 3) -> rules with any consequent size."""
    its, _ = m1_itemsets(spark, sf, max_size=3)
    rules = association_rules(its, min_confidence=MIN_CONFIDENCE)
    return _strings(rules.orderBy(F.desc("confidence"), "antecedent", "consequent"),
                    "antecedent", "consequent")

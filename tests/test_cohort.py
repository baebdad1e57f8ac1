"""Label profile, cohort, transactions (H1-H3) on the FIXTURES samples."""

import math

from cohortmine import (
    baskets,
    cohort,
    cohort_measurements,
    explode_labels,
    label_counts,
    strong_measurements,
    subject_labels,
    transaction_count,
    transactions,
)
from cohortmine.schemas import DEFAULT_LABELS

MEAS = [
    ("p1", 42, 1300000.0),
    ("p1", 7, 1250000.0),
    ("p2", 42, 1250000.5),
    ("p2", 42, 2000000.0),
    ("p3", 9, float("nan")),
    ("p4", 42, 1400000.0),
]
SUBJ = [
    ("p1", "leukemia lymphoma", "1.0"),
    ("p2", "  breast-cancer  leukemia ", "2.0"),
    ("p3", "flu", "3.0"),
]


def _meas(spark):
    return spark.createDataFrame(MEAS, "subject_id string, feature_id int, value double")


def _subj(spark):
    return spark.createDataFrame(SUBJ, "subject_id string, labels string, last string")


def test_label_counts_golden(spark):
    got = {r["label"]: r["cnt"] for r in label_counts(_subj(spark), _meas(spark)).collect()}
    assert got == {"leukemia": 3, "breast-cancer": 2, "lymphoma": 1}


def test_label_counts_order(spark):
    rows = [r["label"] for r in label_counts(_subj(spark), _meas(spark)).collect()]
    assert rows == ["leukemia", "breast-cancer", "lymphoma"]


def test_explode_labels_trims_and_drops_empty(spark):
    rows = sorted(tuple(r) for r in explode_labels(_subj(spark)).collect())
    assert rows == [("p1", "leukemia"), ("p1", "lymphoma"), ("p2", "breast-cancer"),
                    ("p2", "leukemia")]


def test_explode_labels_tabs_and_duplicates(spark):
    df = spark.createDataFrame([("a", "\tleukemia  leukemia\r", "x")],
                               "subject_id string, labels string, last string")
    rows = [r["label"] for r in explode_labels(df).collect()]
    assert rows == ["leukemia", "leukemia"]  # multiplicity kept (D9)


def test_label_counts_repeated_label_counts_twice(spark):
    subj = spark.createDataFrame([("a", "leukemia leukemia", "x")],
                                 "subject_id string, labels string, last string")
    meas = spark.createDataFrame([("a", 42, 2e6)], "subject_id string, feature_id int, value double")
    assert label_counts(subj, meas).collect()[0]["cnt"] == 2


def test_subject_labels_distinct_sorted(spark):
    df = spark.createDataFrame([("a", "lymphoma leukemia lymphoma", "x")],
                               "subject_id string, labels string, last string")
    assert subject_labels(df).collect()[0]["labels"] == "leukemia;lymphoma"


def test_strong_measurements_strict_and_nan(spark):
    rows = strong_measurements(_meas(spark), feature=None, min_value=1250000).collect()
    assert sorted(r["value"] for r in rows) == [1250000.5, 1300000.0, 1400000.0, 2000000.0]
    assert not any(math.isnan(r["value"]) for r in rows)


def test_cohort_and_transactions(spark):
    coh = cohort(_subj(spark), DEFAULT_LABELS)
    assert sorted(r[0] for r in coh.collect()) == ["p1", "p2"]
    rows = cohort_measurements(_meas(spark), coh, 1250000.0).collect()
    assert sorted(r["subject_id"] for r in rows) == ["p1", "p2", "p2"]
    tx = transactions(_meas(spark), coh, 1250000.0)
    assert sorted(tuple(r) for r in tx.collect()) == [("p1", 42), ("p2", 42)]
    assert transaction_count(tx).collect()[0]["n"] == 2
    b = {r["tid"]: list(r["items"]) for r in baskets(tx).collect()}
    assert b == {"p1": [42], "p2": [42]}


def test_transaction_count_is_subjects_with_strong_rows(spark):
    coh = spark.createDataFrame([("p1",), ("p2",), ("p9",)], "subject_id string")
    tx = transactions(_meas(spark), coh, 1250000.0)
    assert transaction_count(tx).collect()[0]["n"] == 2  # p9 has no measurement (D14)


def test_empty_cohort(spark):
    coh = spark.createDataFrame([], "subject_id string")
    tx = transactions(_meas(spark), coh, 0.0)
    assert tx.count() == 0
    assert transaction_count(tx).collect()[0]["n"] == 0


def test_label_counts_pushdown_plan(spark, scratch):
    _meas(spark).write.parquet(f"{scratch}/m")
    meas = spark.read.parquet(f"{scratch}/m")
    plan = label_counts(_subj(spark), meas)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "value" in plan


def test_hot_subject_third_of_rows(spark):
    """One subject owns a third of all measurement rows (duplicates included)."""
    import random

    from cohortmine import mine_itemsets

    rnd = random.Random(9)
    normal = [(f"s{i}", rnd.randint(1, 6), 2e6) for i in range(200) for _ in range(3)]
    hot = [("hot", rnd.randint(1, 6), 2e6) for _ in range(len(normal) // 2)]
    rows = normal + hot
    meas = spark.createDataFrame(rows, "subject_id string, feature_id int, value double")
    subj = spark.createDataFrame([(f"s{i}", "leukemia", "x") for i in range(200)] + [("hot", "leukemia lymphoma", "x")],
                                 "subject_id string, labels string, last string")
    counts = {r["label"]: r["cnt"] for r in label_counts(subj, meas, feature=None, min_value=0).collect()}
    assert counts == {"leukemia": len(rows), "lymphoma": len(hot)}
    tx = transactions(meas, cohort(subj), 0.0)
    baskets_py = {}
    for s_id, f, _ in rows:
        baskets_py.setdefault(s_id, set()).add(f)
    assert tx.count() == sum(len(v) for v in baskets_py.values())
    its, n = mine_itemsets(tx, 0.2, max_size=2)
    assert n == len(baskets_py)
    got = {tuple(r["items"]): r["cnt"] for r in its.collect()}
    for items, cnt in got.items():
        assert cnt == sum(1 for b in baskets_py.values() if set(items) <= b)

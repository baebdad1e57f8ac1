"""Measurements stored by subject: equal results, no Exchange on the measurement side."""

import re

import pytest
from pyspark.sql import functions as F

from cohortmine import baskets, cohort, label_counts, transactions
from cohortmine.sources import stored as st

LABELS = ("x", "y")


def _data(spark, hot=True):
    m = spark.range(4000).select(
        F.concat(F.lit("p"), F.when(F.lit(hot) & (F.col("id") % 3 == 0), F.lit(7)).otherwise(F.col("id") % 211)).alias("subject_id"),
        (F.xxhash64("id") % 9).cast("int").alias("feature_id"), (F.col("id") * 37 % 1000).cast("double").alias("value"),
        F.lit("not stored").alias("Note"))
    odd = spark.createDataFrame([(None, 1, 999.0, "n"), ("p1", None, 999.0, "n"), ("p1", 2, None, "n"), ("p2", 3, float("nan"), "n")], m.schema)
    s = spark.range(230).select(F.concat(F.lit("p"), "id").alias("subject_id"),
                                F.when(F.col("id") % 2 == 0, "x y x").otherwise("z").alias("labels"))
    return m.unionByName(odd).unionByName(m.limit(50)), s


def _same(a, b):
    rows = lambda d: sorted((tuple(map(str, r)) for r in d.select(*sorted(d.columns)).collect()))
    assert rows(a) == rows(b)


@pytest.mark.parametrize("hot", [True, False])
@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_results_equal_the_unstored_operators(spark, scratch, hot, broadcast):
    m, s = _data(spark, hot)
    store = st.store_measurements(m, f"{scratch}/m", buckets=6)
    assert store.has_hot is hot and store.hot.count() == (0 if not hot else m.filter("subject_id = 'p7'").count())
    assert store.even.count() + store.hot.count() == m.filter("subject_id is not null").count()
    c = cohort(s, LABELS).unionByName(spark.createDataFrame([("p7",)], "subject_id string"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        _same(st.stored_transactions(store, c, 300.0), transactions(m, c, 300.0))
        _same(st.stored_baskets(store, c, 300.0), baskets(transactions(m, c, 300.0)))
        for labels in (LABELS, None):
            _same(st.stored_label_counts(store, s, labels, 2, 300.0), label_counts(s, m, labels, 2, 300.0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _moved(plan, scan):
    """Exchanges that stand above the scan of ``scan`` in a plan (by depth of the tree)."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "Scan parquet" in line and scan in line)
    depth = lambda line: len(re.match(r"^[ :+\-]*", line).group())
    found, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            found.append(line)
    return [x for x in found if re.search(r"Exchange|Shuffle", x)]


def test_measurements_do_not_move(spark, scratch):
    m, s = _data(spark, hot=False)
    store = st.store_measurements(m, f"{scratch}/m", buckets=6)
    table = st._table(spark, f"{scratch}/m")
    s.write.parquet(f"{scratch}/s")
    s = spark.read.parquet(f"{scratch}/s")
    c = cohort(s, LABELS)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # sort-merge joins: the cohort moves, the rows don't
    try:
        for df in (st.stored_transactions(store, c, 300.0), st.stored_baskets(store, c, 300.0)):
            plan = _plan(df)
            assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
            assert _moved(plan, table) == [], plan
        counted = _plan(st.stored_label_counts(store, s, LABELS, 2, 300.0))
        moved = [x for x in _moved(counted, table) if "hashpartitioning(subject_id" in x]
        assert moved == [], counted
        plain = _plan(transactions(spark.read.parquet(f"{scratch}/m/even"), c, 300.0))
        assert _moved(plain, "parquet") != []  # the check sees an Exchange where there is one
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_opened_by_another_session(spark, scratch):
    m, s = _data(spark)
    path = f"{scratch}/it's here"
    store = st.store_measurements(m, path, buckets=5)
    want = store.even.count()
    spark.sql(f"DROP TABLE {st._table(spark, path)}")
    again = st.open_measurements(spark, path)
    assert again.buckets == 5 and again.has_hot and again.even.count() == want
    c = cohort(s, LABELS)
    _same(st.stored_transactions(again, c, 300.0), transactions(m, c, 300.0))
    with pytest.raises(Exception, match="exist"):
        st.store_measurements(m, path, buckets=5)


def test_empty_and_hot_bound(spark, scratch):
    m, s = _data(spark)
    store = st.store_measurements(m.filter("1 = 0"), f"{scratch}/e")
    assert not store.has_hot and store.buckets == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert st.stored_baskets(store, cohort(s, LABELS), 0.0).count() == 0
    assert not st.store_measurements(m, f"{scratch}/b", buckets=4, hot_rows=10**9).has_hot
    assert st._buckets_for(10**12, 200) == 29803

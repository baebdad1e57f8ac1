"""Frequent itemsets (H4): brute force, methods, reference counting."""

import itertools
import math
import random

import pytest

from cohortmine import candidates, frequent_itemsets, item_counts
from cohortmine.operators.fpgrowth import fp_itemsets


def _baskets(seed, n_tx=40, n_items=8, p=0.55):
    rnd = random.Random(seed)
    return {t: sorted(i for i in range(1, n_items + 1) if rnd.random() < p) for t in range(n_tx)}


def _tx_df(spark, bask, dup=False):
    rows = [(t, i) for t, items in bask.items() for i in items]
    if dup:  # repeated (tid, item) rows must not change supports
        rows += rows[::3]
    return spark.createDataFrame(rows, "tid long, item int")


def _brute(bask, s, max_size=None, mode="exact"):
    n = sum(1 for b in bask.values() if b)
    items = sorted({i for b in bask.values() for i in b})
    out = {}
    k = 1
    while max_size is None or k <= max_size:
        found = False
        for combo in itertools.combinations(items, k):
            c = sum(1 for b in bask.values() if set(combo) <= set(b))
            rep = c if (mode == "exact" or k < 2) else c // math.factorial(k - 1)
            ratio = rep / n
            if mode == "reference":
                import struct
                ratio = struct.unpack("f", struct.pack("f", ratio))[0]
            if ratio > s:
                out[combo] = rep
                found = True
        if not found:
            break
        k += 1
    return out


def _collect(df):
    return {tuple(r["items"]): r["cnt"] for r in df.collect()}


@pytest.mark.parametrize("method", ["bitmap", "vertical", "partition", "tidjoin", "fpgrowth"])
@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, method, seed):
    bask = _baskets(seed)
    got = _collect(frequent_itemsets(_tx_df(spark, bask, dup=True), 0.25, method=method))
    assert got == _brute(bask, 0.25)


@pytest.mark.parametrize("method", ["bitmap", "vertical", "partition", "tidjoin", "fpgrowth"])
def test_reference_mode_matches_brute_force(spark, method):
    bask = _baskets(7, n_tx=30, p=0.6)
    got = _collect(frequent_itemsets(_tx_df(spark, bask), 0.2, count_mode="reference",
                                     method=method))
    assert got == _brute(bask, 0.2, mode="reference")


def test_max_size_and_k_column(spark):
    bask = _baskets(3)
    df = frequent_itemsets(_tx_df(spark, bask), 0.2, max_size=2)
    rows = df.collect()
    assert {r["k"] for r in rows} <= {1, 2}
    assert all(len(r["items"]) == r["k"] for r in rows)
    assert _collect(df) == _brute(bask, 0.2, max_size=2)


def test_threshold_is_strict(spark):
    # 10 transactions; item 1 in 3 of them: 3/10 > 0.3 is false.
    bask = {t: ([1] if t < 3 else []) + [2] for t in range(10)}
    got = _collect(frequent_itemsets(_tx_df(spark, bask), 0.3))
    assert (1,) not in got and got[(2,)] == 10


def test_reference_float_threshold_quirk(spark):
    # c/n == 0.3 exactly passes with 32-bit float division (D2), not with double.
    bask = {t: ([1] if t < 3 else []) + [2] for t in range(10)}
    exact = _collect(frequent_itemsets(_tx_df(spark, bask), 0.3))
    ref = _collect(frequent_itemsets(_tx_df(spark, bask), 0.3, count_mode="reference"))
    assert (1,) not in exact and (1,) in ref


def test_downward_closure(spark):
    bask = _baskets(11, n_tx=50, n_items=9, p=0.5)
    got = _collect(frequent_itemsets(_tx_df(spark, bask), 0.15))
    for items, cnt in got.items():
        for sub in itertools.combinations(items, len(items) - 1):
            if sub:
                assert sub in got and got[sub] >= cnt


def test_invariant_under_repartition(spark):
    bask = _baskets(5)
    tx = _tx_df(spark, bask)
    a = _collect(frequent_itemsets(tx, 0.25))
    b = _collect(frequent_itemsets(tx.repartition(7).orderBy("item"), 0.25))
    assert a == b


def test_empty_input(spark):
    tx = spark.createDataFrame([], "tid long, item int")
    assert frequent_itemsets(tx, 0.3).count() == 0


def test_string_tids(spark):
    tx = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 2), ("c", 1)],
                               "tid string, item int")
    assert _collect(frequent_itemsets(tx, 0.5)) == {(1,): 3, (2,): 2, (1, 2): 2}


def test_item_counts_rows_vs_distinct(spark):
    tx = spark.createDataFrame([(1, 5), (1, 5), (2, 5)], "tid long, item int")
    assert item_counts(tx).collect()[0]["cnt"] == 2
    assert item_counts(tx, rows=True).collect()[0]["cnt"] == 3


def test_candidates_pairs_and_prune(spark):
    l1 = spark.createDataFrame([([1],), ([2],), ([3],), ([4],)], "items array<int>")
    pairs = sorted(tuple(r["items"]) for r in candidates(l1, 2).collect())
    assert pairs == list(itertools.combinations([1, 2, 3, 4], 2))
    l2 = spark.createDataFrame([([1, 2],), ([1, 3],), ([2, 3],), ([1, 4],)], "items array<int>")
    trip = sorted(tuple(r["items"]) for r in candidates(l2, 3).collect())
    assert trip == [(1, 2, 3)]  # (1,2,4), (1,3,4) pruned: (2,4), (3,4) missing
    unpruned = sorted(tuple(r["items"]) for r in candidates(l2, 3, prune=False).collect())
    assert unpruned == [(1, 2, 3), (1, 2, 4), (1, 3, 4)]


def test_fp_itemsets_inclusive_vs_strict(spark):
    bask = {t: ([1] if t < 3 else []) + [2] for t in range(10)}
    df = spark.createDataFrame([(list(b),) for b in bask.values()], "items array<int>")
    strict = _collect(fp_itemsets(df, 0.3, strict=True))
    loose = _collect(fp_itemsets(df, 0.3, strict=False))
    assert (1,) in loose and (1,) not in strict


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_candidate_plan_has_no_cross_or_theta_join(spark):
    l1 = spark.range(1, 60).selectExpr("array(cast(id as int)) as items")
    c2 = candidates(l1, 2)
    assert c2.count() == 59 * 58 // 2
    l2 = c2.limit(400)
    c3 = candidates(l2, 3)
    c3.count()
    for plan in (_plan(c2), _plan(c3)):
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_null_tids_and_items_ignored(spark):
    tx = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (None, 1), (3, None)], "tid long, item int")
    assert _collect(frequent_itemsets(tx, 0.6)) == {(1,): 2}  # n = 2 (tids 1, 2)


def test_bitmap_large_paths_match(spark, monkeypatch):
    """Force the bucket-partitioned path and the salted join; results must not change."""
    from cohortmine.operators import itemsets as mod

    bask = _baskets(13, n_tx=50, n_items=9, p=0.5)
    tx = _tx_df(spark, bask)
    want = _brute(bask, 0.15)
    monkeypatch.setattr(mod, "BITMAP_BROADCAST_BYTES", 0)
    assert _collect(frequent_itemsets(tx, 0.15, method="bitmap")) == want
    assert _collect(frequent_itemsets(tx, 0.15, broadcast_bytes=0, method="bitmap")) == want


def test_property_methods_equal_brute_force(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    baskets_st = st.dictionaries(st.integers(0, 40), st.lists(st.integers(1, 6), max_size=6),
                                 min_size=1, max_size=25)

    @settings(max_examples=4, deadline=None, derandomize=True,
              suppress_health_check=list(HealthCheck))
    @given(bask=baskets_st, s=st.sampled_from([0.1, 0.25, 0.4]))
    def check(bask, s):
        bask = {t: sorted(set(b)) for t, b in bask.items()}
        if not any(bask.values()):
            return
        want = _brute(bask, s)
        tx = _tx_df(spark, bask)
        for method in ("bitmap", "vertical", "partition", "tidjoin", "fpgrowth"):
            assert _collect(frequent_itemsets(tx, s, method=method)) == want, method

    check()


@pytest.mark.parametrize("tids_per_bucket", [3, 7])
def test_bitmap_many_tid_groups(spark, monkeypatch, tids_per_bucket):
    """Force many tid groups (as with a very large n): small and large level paths,
    including the bucket-local re-partitioning (groups >= task slots)."""
    from cohortmine.operators import itemsets as mod

    bask = _baskets(21, n_tx=60, n_items=8, p=0.55)
    tx = _tx_df(spark, bask, dup=True)
    want = _brute(bask, 0.2)
    monkeypatch.setattr(mod, "TIDS_PER_BUCKET", tids_per_bucket)
    assert _collect(frequent_itemsets(tx, 0.2, method="bitmap")) == want
    monkeypatch.setattr(mod, "BITMAP_BROADCAST_BYTES", 0)
    assert _collect(frequent_itemsets(tx, 0.2, method="bitmap")) == want
    assert _collect(frequent_itemsets(tx, 0.2, broadcast_bytes=0, method="bitmap")) == want
    monkeypatch.setattr(mod, "GROUPS_PER_SALT", 2)
    once = _tx_df(spark, bask)  # reference mode counts repeated rows of single items again
    assert _collect(frequent_itemsets(once, 0.2, count_mode="reference", method="bitmap", broadcast_bytes=0)) \
        == _brute(bask, 0.2, mode="reference")


def test_method_names(spark):
    bask = _baskets(2, n_tx=20)
    tx = _tx_df(spark, bask)
    assert _collect(frequent_itemsets(tx, 0.3, method="levelwise")) == _brute(bask, 0.3)
    with pytest.raises(ValueError):
        frequent_itemsets(tx, 0.3, method="nope")


def test_candidates_tolerate_duplicate_input(spark):
    l2 = spark.createDataFrame([([1, 2],), ([1, 2],), ([1, 3],), ([2, 3],)], "items array<int>")
    assert sorted(tuple(r["items"]) for r in candidates(l2, 3).collect()) == [(1, 2, 3)]


def test_intermediate_checkpoints_are_removed(spark):
    import os

    from cohortmine.operators.itemsets import mine_itemsets

    root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    before = set(os.listdir(root))
    bask = _baskets(4, n_tx=40, n_items=7, p=0.6)
    its, _ = mine_itemsets(_tx_df(spark, bask), 0.2, method="bitmap")
    got = _collect(its)
    assert got == _brute(bask, 0.2)
    added = set(os.listdir(root)) - before
    levels = max(len(items) for items in got)
    # what stays: the level results (L1..Lk) read by the returned frame
    assert len(added) == levels


def test_non_integer_items_rejected(spark):
    tx = spark.createDataFrame([("a", "x"), ("a", "y")], "tid string, item string")
    with pytest.raises(TypeError):
        frequent_itemsets(tx, 0.3)


@pytest.mark.parametrize("cache_levels", [False, True])
def test_bitmap_cache_and_stream_paths(spark, monkeypatch, cache_levels):
    """AND results cached or streamed to a checkpoint."""
    from cohortmine.operators import itemsets as mod

    bask = _baskets(17, n_tx=45, n_items=8, p=0.55)
    tx = _tx_df(spark, bask)

    def mined(**kw):
        return _collect(mod.mine_itemsets(tx, 0.15, method="bitmap", cache_levels=cache_levels, **kw)[0])

    assert mined() == _brute(bask, 0.15)
    monkeypatch.setattr(mod, "TIDS_PER_BUCKET", 5)
    monkeypatch.setattr(mod, "BITMAP_BROADCAST_BYTES", 0)
    assert mined(count_mode="reference") == _brute(bask, 0.15, mode="reference")


def test_methods_agree_where_the_share_is_not_a_float(spark):
    # ceil(0.07 * 100) is 8 in doubles, yet 7/100 passes in 32-bit comparison.
    rows = [(t, 0) for t in range(100)] + [(t, 1) for t in range(7)]
    tx = spark.createDataFrame(rows, "tid long, item int")
    want = {(0,): 100, (1,): 7, (0, 1): 7}
    for method in ("bitmap", "vertical", "partition", "tidjoin", "fpgrowth"):
        assert _collect(frequent_itemsets(tx, 0.07, count_mode="reference", method=method)) == want, method


@pytest.mark.parametrize("n, c", [(30, 9), (49, 7), (100, 29), (1000, 70), (77, 11)])
def test_least_count_at_equality(n, c):
    import struct

    from cohortmine.operators.itemsets import least_count

    f32 = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    for s in (c / n, f32(c / n)):
        assert least_count(n, s) == min([k for k in range(n + 1) if k / n > s], default=n + 1)
        assert least_count(n, s, "reference") == min([k for k in range(n + 1) if f32(k / n) > s], default=n + 1)


@pytest.mark.parametrize("method", ["bitmap", "vertical", "partition", "tidjoin", "fpgrowth"])
def test_reference_mode_counts_rows_of_single_items(spark, method):
    # item 2 is in 2 of 4 transactions but in 4 rows; pairs count transactions.
    rows = [(1, 1), (2, 1), (3, 1), (4, 1), (1, 2), (1, 2), (2, 2), (2, 2)]
    tx = spark.createDataFrame(rows, "tid long, item int")
    got = _collect(frequent_itemsets(tx, 0.6, count_mode="reference", method=method))
    assert got == {(1,): 4, (2,): 4}
    got = _collect(frequent_itemsets(tx, 0.4, count_mode="reference", method=method))
    assert got == {(1,): 4, (2,): 4, (1, 2): 2}
    assert _collect(frequent_itemsets(tx, 0.4, method=method)) == {(1,): 4, (2,): 2, (1, 2): 2}


def test_ids_outside_int_fail_whatever_the_mode(spark):
    tx = spark.createDataFrame([(1, 1), (1, 4294967297)], "tid long, item long")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="out of range"):
                frequent_itemsets(tx, 0.3)
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_callers_cache_is_left_alone(spark):
    from cohortmine import fp_rules

    df = spark.createDataFrame([([1, 2],), ([1],)], "items array<int>").cache()
    df.count()
    fp_itemsets(df, 0.3)
    fp_rules(df, 0.3, 0.5)
    assert df.storageLevel.useMemory
    df.unpersist()
    tx = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "tid long, item int").cache()
    tx.count()
    frequent_itemsets(tx, 0.3)
    assert tx.storageLevel.useMemory
    tx.unpersist()


def test_cooccurring_pairs_lists_only_what_occurs(spark):
    from cohortmine import cooccurring_pairs

    tx = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, 3), (3, 2), (3, 3), (4, 4)], "tid long, item int")
    assert {tuple(r["items"]): r["cnt"] for r in cooccurring_pairs(tx).collect()} == {(1, 2): 1, (2, 3): 2}


def test_bitmap_plan_lists_no_pair_that_never_occurs(spark):
    # 60 items, each alone in its transaction: no pair exists and none is made.
    tx = spark.createDataFrame([(t, t) for t in range(60)], "tid long, item int")
    assert len(_collect(frequent_itemsets(tx, 0.001, method="bitmap"))) == 60


def test_ordered_output(spark):
    bask = _baskets(9)
    rows = [(r["k"], -r["cnt"], tuple(r["items"])) for r in
            frequent_itemsets(_tx_df(spark, bask), 0.2, ordered=True).collect()]
    assert rows == sorted(rows)


def _fp_brute(baskets, least):
    out = {}
    for b in baskets:
        for k in range(1, len(b) + 1):
            for c in itertools.combinations(sorted(b), k):
                out[c] = out.get(c, 0) + 1
    return {c: n for c, n in out.items() if n >= least}


def test_fpgrowth_in_blocks_and_parts(spark, monkeypatch):
    """Paths in many blocks and the sets dealt in parts: the same sets, whole."""
    import random

    from cohortmine.operators import fpgrowth, growth

    rng = random.Random(5)
    bask = [[x for x in range(9) if rng.random() < 0.5] for _ in range(120)]
    df = spark.createDataFrame([(b,) for b in bask], "items array<int>").repartition(3)
    want = _fp_brute(bask, 12)
    assert _collect(fpgrowth.frequent_sets(df, 12)) == want
    assert _collect(fpgrowth.frequent_sets(df, 12, num_partitions=5, broadcast_bytes=256)) == want
    monkeypatch.setattr(growth, "BLOCK_ITEMS", 16)
    monkeypatch.setattr(growth, "MERGE_ITEMS", 0)
    assert _collect(fpgrowth.frequent_sets(df, 12, max_size=3)) == {c: n for c, n in want.items() if len(c) <= 3}


@pytest.mark.parametrize("method", ["sets", "mined"])
def test_fpgrowth_stops_at_the_size_asked_for(spark, method):
    """One basket of 40 items, twice: the library lists 2 ** 40 sets before a bound on size is applied."""
    from cohortmine.operators.fpgrowth import frequent_sets

    if method == "sets":
        df = spark.createDataFrame([(list(range(40)),)] * 2, "items array<int>")
        got = _collect(frequent_sets(df, 2, max_size=2))
    else:
        tx = spark.createDataFrame([(t, i) for t in range(2) for i in range(40)], "tid long, item int")
        got = _collect(frequent_itemsets(tx, 0.5, max_size=2, method="fpgrowth"))
    assert len(got) == 40 + 780 and set(got.values()) == {2}


def test_fp_itemsets_equal_the_library(spark):
    """Odd baskets as Spark ML takes them: null, empty and repeated baskets, text items, ties."""
    from cohortmine import fp_model, fp_rules

    rows = [["b", "a"], ["a", "b"], ["c", "a", "b"], [], None, ["c"], ["é", "a"], ["a", "b", "c"], ["é", "c"]]
    df = spark.createDataFrame([(r,) for r in rows], "items array<string>")
    for support in (0.0, 0.25, 0.5, 1.0):
        model = fp_model(df, support, 0.4)
        want = {tuple(sorted(r["items"])): r["freq"] for r in model.freqItemsets.collect()}
        assert _collect(fp_itemsets(df, support, strict=False)) == want
        rules = {(tuple(sorted(r[0])), *r[1], *r[2:]) for r in model.associationRules.collect()}
        assert {(tuple(r[0]), *r[1], *r[2:]) for r in fp_rules(df, support, 0.4).collect()} == rules
    assert fp_itemsets(df.limit(0), 0.3).count() == 0
    with pytest.raises(Exception, match="unique"):
        fp_itemsets(spark.createDataFrame([([1, 1],)], "items array<int>"), 0.3)
    odd = spark.createDataFrame([([(1, "x"), (2, "y")],), ([(1, "x")],)], "items array<struct<a:int,b:string>>")
    assert {tuple(tuple(x) for x in r["items"]) for r in fp_itemsets(odd, 0.5, strict=False).collect()} == {
        ((1, "x"),), ((2, "y"),), ((1, "x"), (2, "y"))}


@pytest.mark.parametrize("kind, values", [
    ("date", ["2020-01-02", "2021-03-04"]), ("timestamp", ["2020-01-02 03:04:05", "2021-01-01 00:00:00"]),
    ("decimal(9,2)", ["1.50", "2.25"]), ("double", ["0.5", "1e300"]), ("boolean", ["true", "false"]), ("binary", ["x", "y"])])
def test_fp_itemsets_of_other_item_types(spark, kind, values):
    df = spark.createDataFrame([(values,), (values,), (values[:1],)], "items array<string>").selectExpr(f"cast(items as array<{kind}>) items")
    out = fp_itemsets(df, 0.5)
    assert out.schema["items"].dataType == df.schema["items"].dataType
    assert sorted((r["k"], r["cnt"]) for r in out.collect()) == [(1, 2), (1, 3), (2, 2)]

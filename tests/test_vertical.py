"""Vertical sets, candidate prefix trees and partition mining."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from cohortmine import frequent_itemsets
from cohortmine.operators import itemsets as mod
from cohortmine.operators import vertical as v


def _db(seed, tids=400, items=12, p=0.4):
    rng = random.Random(seed)
    share = [min(0.97, p * rng.random() * 3) for _ in range(items)]
    return {i * 3 - 5: sorted(t for t in range(tids) if rng.random() < share[i]) for i in range(items)}


def _group(db):
    g = v.Group(0)
    for item in sorted(db):
        if db[item]:
            g.items.append(item)
            g.ids.append(np.array(db[item], np.int32))
    return g


def _plain(db, combo):
    return len(set.intersection(*(set(db[i]) for i in combo)))


def _kinds(cls, depth=0):
    yield cls.kind
    if depth < 3:
        for i in range(len(cls.items)):
            child = cls.child(i, np.ones(len(cls.items) - i - 1, bool))
            if child is not None:
                yield from _kinds(child, depth + 1)


@pytest.mark.parametrize("p", [0.02, 0.15, 0.5, 0.95])
def test_every_path_counts_right_in_every_kind(p):
    db = _db(int(p * 100), p=p)

    def walk(cls, prefix):
        for i, x in enumerate(cls.items.tolist()):
            assert cls.counts[i] == _plain(db, [*prefix, x])
            keep = np.array([(i + j) % 4 != 3 for j in range(len(cls.items) - i - 1)], bool)
            child = cls.child(i, keep)
            if child is not None and len(prefix) < 3:
                assert not child.mark.any()
                walk(child, [*prefix, x])

    walk(_group(db).root(), [])


def test_kinds_follow_density():
    sparse, dense = _db(1, tids=6000, p=0.004), {i: [t for t in range(3000) if t % (400 + i)] for i in range(8)}
    assert set(_kinds(_group(sparse).root())) == {"list"}
    found = list(_kinds(_group(dense).root()))
    assert found[0] == "bits" and "diff" in found  # nearly full sets go on as diffsets


def test_prefix_tree_of_mixed_sizes():
    db = _db(4, items=9, p=0.6)
    names = sorted(db)
    rng = random.Random(2)
    combos = [c for k in (1, 2, 3, 4, 5) for c in itertools.combinations(names, k) if rng.random() < 0.3]
    combos.append((names[0], 1000))  # an item that the group does not hold
    rows = np.full((len(combos), 5), v.END, np.int64)
    for r, c in enumerate(combos):
        rows[r, :len(c)] = c
    tree = v.PrefixTree(rows)
    for _ in range(2):
        tree.count(_group(db).root())
    for row, n in zip(tree.rows.tolist(), tree.counts.tolist(), strict=True):
        combo = [x for x in row if x != v.END]
        assert n == 2 * (0 if 1000 in combo else _plain(db, combo))


def _tx(spark, seed, tids=300, items=14, p=0.3):
    rng = random.Random(seed)
    rows = [(t, i * 7) for t in range(tids) for i in range(items) if rng.random() < p * (1.6 if i < 4 else 0.7)]
    return spark.createDataFrame(rows, "tid long, item int"), rows


def _collect(df):
    out = [(tuple(r["items"]), r["cnt"]) for r in df.collect()]
    assert len(out) == len(dict(out))
    return dict(out)


def test_groups_keep_every_pair_once(spark):
    tx, rows = _tx(spark, 3)
    groups = v.vertical_groups(tx, 5)
    seen, parts = 0, {}
    for part, batch in enumerate(groups.rdd.glom().map(lambda rs: [(r["g"], r["item"], r["cnt"], r["ids"], r["bits"]) for r in rs]).collect()):
        for g, item, cnt, ids, bits in batch:
            assert parts.setdefault(g, part) == part
            assert ids is not None and len(ids) == cnt and ids == sorted(set(ids))
            seen += cnt
    assert seen == len(rows) and len(parts) == 5


def test_dense_items_are_stored_as_bitmaps(spark):
    tx = spark.range(3000).selectExpr("id as tid", "explode(array(1, if(id % 100 = 0, 2, 1), 3)) as item").distinct()
    rows = {r["item"]: r for r in v.vertical_groups(tx, 1).collect()}
    assert rows[1]["ids"] is None and len(rows[1]["bits"]) == 4096 and rows[2]["bits"] is None
    # a sparse item takes less than a tenth of its bitmap
    assert 4 * len(rows[2]["ids"]) < 410
    assert _collect(frequent_itemsets(tx, 0.001, method="vertical"))[(1, 2, 3)] == 30


def test_groups_beyond_a_bitmap_are_cut(spark, monkeypatch):
    monkeypatch.setattr(v, "GROUP_BITS", 64)
    tx, _ = _tx(spark, 9)
    want = _collect(frequent_itemsets(tx, 0.1, method="tidjoin"))
    groups = v.vertical_groups(tx, 2)
    assert groups.select("g").distinct().count() >= 4
    monkeypatch.setattr(mod, "vertical_groups", lambda f, n: groups)
    monkeypatch.setattr(mod, "_drop_checkpoint", lambda df: None)
    assert _collect(frequent_itemsets(tx, 0.1, method="vertical")) == want


@pytest.mark.parametrize("method", ["vertical", "partition"])
@pytest.mark.parametrize("bound", [1 << 26, 900])
def test_many_groups_and_split_trees(spark, method, bound, monkeypatch):
    """Several groups; candidates beyond the broadcast bound are counted in parts."""
    monkeypatch.setattr(mod, "_group_number", lambda n, parallelism, smallest=0: 7)
    monkeypatch.setattr(mod, "LOCAL_LEAST", 2)
    tx, _ = _tx(spark, 5)
    for support, size in ((0.08, None), (0.05, 3), (0.2, 2)):
        want = _collect(frequent_itemsets(tx, support, max_size=size, method="tidjoin"))
        assert _collect(frequent_itemsets(tx, support, max_size=size, method=method, broadcast_bytes=bound)) == want
    want = _collect(frequent_itemsets(tx, 0.03, count_mode="reference", method="tidjoin"))
    assert _collect(frequent_itemsets(tx, 0.03, count_mode="reference", method=method, broadcast_bytes=bound)) == want


def test_partition_falls_back_where_groups_are_too_small(spark, monkeypatch):
    monkeypatch.setattr(mod, "_group_number", lambda n, parallelism, smallest=0: 50)
    called = []
    real = mod._vertical_levels
    monkeypatch.setattr(mod, "_vertical_levels", lambda *a: called.append(1) or real(*a))
    tx, _ = _tx(spark, 6)
    want = _collect(frequent_itemsets(tx, 0.1, method="tidjoin"))
    assert _collect(frequent_itemsets(tx, 0.1, method="partition")) == want and called


def test_partition_counts_once(spark, monkeypatch):
    """Two passes over the groups, whatever the itemsets' sizes."""
    passes = []
    real = mod.candidate_counts
    monkeypatch.setattr(mod, "candidate_counts", lambda *a: passes.append(1) or real(*a))
    monkeypatch.setattr(mod, "_group_number", lambda n, parallelism, smallest=0: 4)
    tx, _ = _tx(spark, 7, p=0.6)
    got = _collect(frequent_itemsets(tx, 0.15, method="partition"))
    assert max(map(len, got)) >= 4 and passes == [1]


def test_pairs_are_handed_on_when_a_task_holds_many(monkeypatch):
    g = _group({1: [0, 1, 2], 2: [1, 2], 9: [2]})
    got = {}
    for key, n in v._pairs_of(g):
        for k, c in zip(key.tolist(), n.tolist(), strict=True):
            got[k >> 32, k & 0xFFFFFFFF] = c
    assert got == {(1, 2): 2, (1, 9): 1, (2, 9): 1}
    batches = list(v._pair_batches(np.array([(5 << 32) | 7, (1 << 32) | 0xFFFFFFFB]), np.array([2, 3])))
    assert pa.Table.from_batches(batches).to_pylist() == [{"x": 5, "y": 7, "cnt": 2}, {"x": 1, "y": -5, "cnt": 3}]


def test_groups_are_never_shuffled_again(spark):
    tx, _ = _tx(spark, 8)
    plan = v.candidate_counts(v.vertical_groups(tx, 3), np.array([[0, 7]]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the counts alone

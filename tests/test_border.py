"""Sampling with a negative border and mining of arriving batches equal a plain mining run."""

import random

import pytest

from cohortmine.operators.border import sampled_itemsets, stored_itemsets, update_itemsets
from cohortmine.operators.itemsets import mine_itemsets
from cohortmine.streaming import start_itemsets

SCHEMA = "tid string, item int"


def _rows(seed, n, items=9, shift=0):
    r = random.Random(seed)
    return [(f"t{shift + t}", i) for t in range(n) for i in range(items) if r.random() < 0.25 + 0.5 * (i % 3 == 0)]


def _plain(rows, support, max_size=None):
    """Brute force over all subsets of the items."""
    from itertools import combinations

    carts = {}
    for t, i in rows:
        if t is not None and i is not None:
            carts.setdefault(t, set()).add(i)
    items = sorted({i for c in carts.values() for i in c})
    out = {}
    for k in range(1, (max_size or len(items)) + 1):
        level = {s: c for s in combinations(items, k) if (c := sum(set(s) <= cart for cart in carts.values())) / len(carts) > support}
        if not level:
            break
        out |= level
    return out


def _got(df):
    rows = df.collect()
    assert all(r.k == len(r["items"]) for r in rows)
    out = {tuple(r["items"]): r.cnt for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("lowered, missed", [(0.05, False), (0.95, True), (None, None)])
def test_sample_is_exact_on_both_branches(spark, lowered, missed):
    rows = _rows(1, 150) + [(None, 1), ("t1", None)]
    got, n, passes = sampled_itemsets(spark.createDataFrame(rows + rows[:50], SCHEMA), 0.15, fraction=0.3, lowered=lowered)
    assert n == 150 and _got(got) == _plain(rows, 0.15)
    assert missed is None or (passes > 0) == missed


@pytest.mark.parametrize("max_size", [1, 2])
def test_sample_sizes(spark, max_size):
    rows = _rows(2, 60)
    got, _, _ = sampled_itemsets(spark.createDataFrame(rows, SCHEMA), 0.2, max_size=max_size, fraction=0.5)
    assert _got(got) == _plain(rows, 0.2, max_size)


def test_sample_of_nothing(spark):
    assert sampled_itemsets(spark.createDataFrame([], SCHEMA), 0.2)[1:] == (0, 0)
    rows = _rows(3, 20)  # a sample without a transaction
    got, _, passes = sampled_itemsets(spark.createDataFrame(rows, SCHEMA), 0.3, fraction=1e-6)
    assert _got(got) == _plain(rows, 0.3) and passes > 0


def test_batches_equal_a_batch_run(spark, scratch):
    """Pieces of old transactions, new items, promoted and dropped sets, an empty batch, a batch taken twice."""
    whole = _rows(4, 80)
    batches = [whole[::2], [], whole[1::2], [(f"n{t}", i) for t in range(60) for i in (1, 2, 30)], whole[:40]]
    seen = []
    for b, rows in enumerate(batches):
        seen += rows
        for _ in range(2 if b == 2 else 1):
            update_itemsets(scratch, spark.createDataFrame(rows, SCHEMA), b, 0.2)
        got, n = stored_itemsets(spark, scratch)
        assert _got(got) == _plain(seen, 0.2) and n == len({t for t, _ in seen})
    assert _got(stored_itemsets(spark, scratch, 0)[0]) == _plain(batches[0], 0.2)
    assert spark.read.parquet(f"{scratch}/totals").filter("batch = 4").first().passes == 0  # nothing new
    with pytest.raises(ValueError):
        update_itemsets(scratch, spark.createDataFrame([], SCHEMA), 9, 0.5)


def test_unchanged_borders_need_no_recount(spark, scratch):
    rows = _rows(5, 60)
    again = [(f"again-{t}", i) for t, i in rows]
    assert update_itemsets(scratch, spark.createDataFrame(rows, SCHEMA), 0, 0.2, whole=True) > 0
    assert update_itemsets(scratch, spark.createDataFrame(again, SCHEMA), 1, 0.2, whole=True) == 0
    assert _got(stored_itemsets(spark, scratch)[0]) == _plain(rows + again, 0.2)


def test_stream_of_files_and_restart(spark, scratch):
    batches = [_rows(6, 40), _rows(7, 40, shift=30), _rows(8, 40, shift=60)]
    seen = []
    for b, rows in enumerate(batches):  # every round is a restart from the checkpoint
        seen += rows
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{scratch}/in")
        q = start_itemsets(stream, f"{scratch}/state", f"itemsets_{b}", 0.2, max_size=3,
                           checkpoint_location=f"{scratch}/ckpt", available_now=True)
        q.awaitTermination(240)
        assert q.exception() is None
        want, n = mine_itemsets(spark.createDataFrame(seen, SCHEMA), 0.2, max_size=3)
        got, m = stored_itemsets(spark, f"{scratch}/state")
        assert _got(got) == _got(want) and n == m

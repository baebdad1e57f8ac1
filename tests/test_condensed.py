"""Closed and maximal itemsets, rules by growing consequents, hashed pair buckets."""

import random

import pytest

from cohortmine import (
    association_rules,
    closed_itemsets,
    cooccurring_pairs,
    frequent_itemsets,
    frequent_pairs,
    grown_rules,
    maximal_itemsets,
    supports_from_closed,
)


@pytest.fixture(scope="module")
def mined(spark):
    rng = random.Random(4)
    rows = [(t, i) for t in range(60) for i in range(9) if rng.random() < (0.9 if i < 3 else 0.45)]
    rows += [(t, 20) for t in range(60) if (t, 0) in set(rows)]  # 20 goes with 0 always: not all sets are closed
    tx = spark.createDataFrame(rows, "tid long, item int")
    return frequent_itemsets(tx, 0.2, method="tidjoin").checkpoint()


def _sets(df):
    out = [(tuple(r["items"]), r["cnt"]) for r in df.collect()]
    assert len(out) == len(dict(out))
    return dict(out)


def test_closed_and_maximal_equal_their_definitions(mined):
    every = _sets(mined)
    above = {x: [y for y in every if set(x) < set(y)] for x in every}
    closed = {x: c for x, c in every.items() if all(every[y] != c for y in above[x])}
    assert _sets(closed_itemsets(mined)) == closed and len(closed) < len(every)
    assert _sets(maximal_itemsets(mined)) == {x: c for x, c in every.items() if not above[x]}


def test_supports_are_rebuilt_from_the_closed(mined, spark):
    closed = closed_itemsets(mined).checkpoint()
    got = supports_from_closed(closed)
    assert _sets(got) == _sets(mined)
    assert got.columns == ["items", "k", "cnt"]
    assert supports_from_closed(closed.limit(0)).collect() == []
    assert closed_itemsets(mined.limit(0)).collect() == [] and maximal_itemsets(mined.limit(0)).collect() == []


def _rules(df):
    out = [(tuple(r["antecedent"]), tuple(r["consequent"]), r["confidence"]) for r in df.collect()]
    assert len(out) == len(set(out))
    return sorted(out)


@pytest.mark.parametrize("confidence, k", [(0.6, None), (0.9, None), (0.3, 3)])
def test_grown_rules_equal_all_subsets(mined, confidence, k):
    want = _rules(association_rules(mined, min_confidence=confidence, k=k))
    assert _rules(grown_rules(mined, min_confidence=confidence, k=k)) == want and want


def test_a_long_itemset_is_split(spark):
    """30 items: 2^30 subsets, of which only the counted ones can be antecedents."""
    items = list(range(30))
    rows = [(items, 90)] + [([x for x in items if x != y], 100 if y else 400) for y in items]
    df = spark.createDataFrame(rows, "items array<int>, cnt long")
    got = _rules(grown_rules(df, min_confidence=0.5, k=30))
    assert [r[1] for r in got] == [(y,) for y in range(29, 0, -1)][::-1] or sorted(r[1] for r in got) == [(y,) for y in range(1, 30)]
    assert {r[2] for r in got} == {0.9}


def test_hashed_pair_buckets_lose_nothing(spark):
    rng = random.Random(6)
    rows = sorted({(t, rng.choice([1, 2, 3, rng.randrange(200)])) for t in range(150) for _ in range(8)})
    tx = spark.createDataFrame(rows, "tid long, item int")
    want = {x: c for x, c in _sets(cooccurring_pairs(tx)).items() if c >= 6}
    for slots in (1, 64, 1 << 20):  # with one slot nothing is dropped beforehand
        assert _sets(frequent_pairs(tx, 6, slots)) == want
    assert want

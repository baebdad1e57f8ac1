"""Rules, subsets and the support report (H5, H6, P7, U1) incl. the fixture golden."""

import pytest

from cohortmine import association_rules, expand_subsets, rule_complement, support_report
from cohortmine.functions import half_up_milli
from cohortmine.sources.text_io import read_itemsets_text

# Fixture: counted 3-itemsets and counted 1-/2-itemsets (FIXTURES.md section 3).
SIZE3 = ["785, 1;2;3", "456, 1;3;5", "132, 2;3;5"]
SMALLER = ["200, 1;", "300, 2;", "500, 3;", "900, 5;", "200, 1;2;", "2356, 1;3;", "123, 1;5;",
           "2345, 2;3;", "235, 2;5;", "1245, 3;5;"]
GOLDEN = {
    ((1,), (2, 3)): 3.925,
    ((1, 2), (3,)): 3.925,
    ((1, 5), (3,)): 3.707,
    ((2,), (1, 3)): 2.617,
    ((1,), (3, 5)): 2.28,
    ((3,), (1, 2)): 1.57,
    ((3,), (1, 5)): 0.912,
}


def _write(path, lines):
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


@pytest.fixture()
def fixture_itemsets(spark, scratch):
    _write(f"{scratch}/k3.txt", SIZE3)
    _write(f"{scratch}/small.txt", SMALLER)
    return (read_itemsets_text(spark, f"{scratch}/k3.txt"),
            read_itemsets_text(spark, f"{scratch}/small.txt"))


def test_fixture_subset_rows(fixture_itemsets):
    k3, _ = fixture_itemsets
    assert expand_subsets(k3).count() == 18


def test_fixture_rules_golden(fixture_itemsets):
    k3, small = fixture_itemsets
    rules = association_rules(k3, small, min_confidence=0.6)
    got = {(tuple(r["antecedent"]), tuple(r["consequent"])): r["confidence"] for r in rules.collect()}
    assert got == GOLDEN


def test_set_difference_probe(spark):
    # 1;2;3; minus 1; = 2;3;
    df = spark.createDataFrame([([1, 2, 3], 10)], "items array<int>, cnt long")
    rows = {tuple(r["antecedent"]): tuple(r["consequent"]) for r in expand_subsets(df).collect()}
    assert rows[(1,)] == (2, 3)


def test_subset_masks_order_and_count(spark):
    df = spark.createDataFrame([([4, 7, 9, 11], 5), ([3], 2)], "items array<int>, cnt long")
    rows = expand_subsets(df).collect()
    assert len(rows) == 2 ** 4 - 2  # single-item sets have no proper subsets
    for r in rows:
        a, c = list(r["antecedent"]), list(r["consequent"])
        assert a and c and sorted(a + c) == [4, 7, 9, 11] and not set(a) & set(c)
        assert a == sorted(a) and c == sorted(c)


def test_missing_subset_drops_rule(spark):
    its = spark.createDataFrame([([1, 2], 5)], "items array<int>, cnt long")
    counted = spark.createDataFrame([([1], 10)], "items array<int>, cnt long")
    rc = rule_complement(its, counted).collect()
    assert [(list(r["antecedent"]), list(r["consequent"])) for r in rc] == [([1], [2])]


@pytest.mark.parametrize("cnt,ante,keep", [(6004, 10000, False), (6005, 10000, True),
                                           (3, 5, False), (7, 10, True)])
def test_confidence_filter_on_rounded_value(spark, cnt, ante, keep):
    its = spark.createDataFrame([([1, 2], cnt)], "items array<int>, cnt long")
    counted = spark.createDataFrame([([1], ante), ([2], 10 ** 9)], "items array<int>, cnt long")
    rules = association_rules(its, counted, min_confidence=0.6).collect()
    assert (len(rules) == 1) == keep


def test_half_up_rounding(spark):
    df = spark.createDataFrame([(1, 16), (2001, 2000), (1, 3), (2, 3)], "a long, b long")
    got = [r[0] for r in df.select(half_up_milli("a", "b")).collect()]
    assert got == [63, 1001, 333, 667]  # 0.0625 -> 0.063, 1.0005 -> 1.001


def test_support_report(spark):
    its = spark.createDataFrame([([1, 2, 3], 270), ([2], 5)], "items array<int>, cnt long")
    rows = support_report(its, 899, k=3).collect()
    assert [(r["support"], list(r["items"])) for r in rows] == [(0.3, [1, 2, 3])]


def test_rule_properties_on_mined_itemsets(spark):
    import random

    from cohortmine import mine_itemsets

    rnd = random.Random(5)
    rows = [(t, i) for t in range(60) for i in range(1, 9) if rnd.random() < 0.5]
    tx = spark.createDataFrame(rows, "tid long, item int")
    its, n = mine_itemsets(tx, 0.15, max_size=4)
    counts = {tuple(r["items"]): r["cnt"] for r in its.collect()}
    rules = association_rules(its, min_confidence=0.0).collect()
    assert rules
    for r in rules:
        a, c = tuple(r["antecedent"]), tuple(r["consequent"])
        assert not set(a) & set(c)
        whole = tuple(sorted(a + c))
        assert whole in counts
        assert 0 < r["confidence"] <= 1
        assert r["confidence"] == round(counts[whole] / counts[a] + 1e-12, 3)


def test_itemset_sources_as_comma_list(spark, scratch):
    _write(f"{scratch}/k3.txt", SIZE3)
    _write(f"{scratch}/small.txt", SMALLER)
    both = read_itemsets_text(spark, f"{scratch}/k3.txt,{scratch}/small.txt")
    assert both.count() == len(SIZE3) + len(SMALLER)


def test_expand_subsets_counts_and_partition(spark):
    import random

    rnd = random.Random(3)
    rows = [(sorted(rnd.sample(range(1, 30), rnd.randint(1, 7))), i) for i in range(25)]
    df = spark.createDataFrame(rows, "items array<int>, cnt long")
    out = expand_subsets(df).collect()
    assert len(out) == sum(2 ** len(items) - 2 for items, _ in rows)
    seen = set()
    for r in out:
        a, c, items = list(r["antecedent"]), list(r["consequent"]), list(r["items"])
        assert a and c and sorted(a + c) == items
        seen.add((tuple(items), tuple(a)))
    assert len(seen) == len(out)  # every proper subset exactly once


@pytest.mark.parametrize("size", [2, 15, 16, 17, 20])
def test_subset_rows_of_larger_sets(spark, size):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(list(range(size)), 1)], "items array<int>, cnt long")
    rows = expand_subsets(df).select((F.size("antecedent") * 100 + F.size("consequent")).alias("s"))
    got = rows.agg(F.count("*"), F.min("s"), F.max("s")).first()
    assert tuple(got) == (2**size - 2, 100 + size - 1, 100 * (size - 1) + 1)


def test_no_row_holds_all_masks(spark):
    df = spark.createDataFrame([(list(range(30)), 1)], "items array<int>, cnt long")
    plan = expand_subsets(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 4  # four parts of at most 16 bits


@pytest.mark.parametrize("size", [63, 64, 65])
def test_sets_too_large_to_enumerate_fail(spark, size):
    df = spark.createDataFrame([(list(range(size)), 1)], "items array<int>, cnt long")
    with pytest.raises(Exception, match="too large"):
        expand_subsets(df).limit(1).collect()


def test_half_up_is_exact_beyond_doubles(spark):
    from pyspark.sql import functions as F

    from cohortmine.functions import reference_count

    num, den = 5758057497609, 15093204449827
    big = 9 * 10**17
    df = spark.createDataFrame([(num, den), (big, 2 * big)], "n long, d long")
    got = [r[0] for r in df.select(half_up_milli("n", "d")).collect()]
    assert got == [(2000 * num + den) // (2 * den), 500]
    assert df.select(reference_count(F.lit(9007199254740993), 3)).first()[0] == 9007199254740993 // 2


def test_ordered_rules(spark):
    df = spark.createDataFrame([([1], 10), ([2], 4), ([1, 2], 4)], "items array<int>, cnt long")
    rows = association_rules(df, min_confidence=0.1, ordered=True).collect()
    assert [r["confidence"] for r in rows] == [1.0, 0.4]

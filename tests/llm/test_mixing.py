import math

import pytest

from cohortmine.llm import mixing as mx


def _docs(spark, sizes, start=0):
    rows, i = [], start
    for source, many in sizes.items():
        for n in many:
            rows.append((i, " ".join(["w"] * n), source))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def _targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + [None] * (None in sizes)
    total = sum(sizes.values())
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, fixed = {}, set()
    while True:
        rest = total - sum(cap * sizes[s] for s in fixed)
        free = sum(w[s] for s in names if s not in fixed)
        out = {s: cap * sizes[s] if s in fixed else rest * w[s] / free for s in names}
        over = {s for s in names if s not in fixed and out[s] > cap * sizes[s]}
        if not over:
            return out
        fixed |= over


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 10, "c": 1000, None: 5}, {"x": 7}, {"a": 0, "b": 5, "c": 9},
    {"a": 1, "b": 1, "c": 1, "d": 10**6, "e": 3, "Z": 50}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mx.targets(df).collect()}
    want = _targets(sizes)
    assert set(got) == set(want) and all(math.isclose(got[s], want[s], rel_tol=1e-12, abs_tol=1e-9) for s in want)


def test_taken_meets_targets_and_order_is_by_key(spark):
    sizes = {"a": [3, 50, 7, 0, 21] * 30, "b": [10] * 200, "c": [5] * 900, None: [4, 4]}
    df = _docs(spark, sizes)
    rows = mx.mix(df, bucket_rows=16).collect()
    assert len(rows) == sum(map(len, sizes.values()))
    for s, many in sizes.items():
        own = [r for r in rows if r["source"] == s]
        assert {r["source_size"] for r in own} == {sum(many)}
        taken, target = sum(r["taken"] for r in own), own[0]["target"]
        assert abs(taken - target) <= max(many) / 2 + 1
        assert all(r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in own)
        assert len({r["copies"] for r in own if r["size"]}) <= 2  # whole epochs, then a part
    again = mx.mix(df.repartition(7), bucket_rows=100_000).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))  # buckets and partitions change nothing


def test_better_documents_come_first(spark):
    rows = [(i, " ".join(["word"] * 20) if i % 2 else " ".join(["7%$1"] * 20), "s" if i < 400 else "t") for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mx.mix(df, weights=(1.0, 5.0)).filter("source = 's'").collect()
    good = sum(r["copies"] for r in got if r["doc_id"] % 2)
    assert good > 2 * sum(r["copies"] for r in got if r["doc_id"] % 2 == 0)


def test_mixed_documents_repeat_rows(spark):
    df = _docs(spark, {"a": [10] * 30, "b": [10] * 100, "c": [10] * 300})
    df = df.unionByName(df.filter("doc_id < 4"))
    plan = mx.mix(df)
    want = sum(r["copies"] for r in plan.collect())
    out = mx.mixed_documents(df)
    assert out.columns == df.columns and out.count() == want
    per = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").count().withColumnRenamed("count", "n").collect()}
    copies = {}
    for r in plan.collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + r["copies"]
    assert per == {k: v for k, v in copies.items() if v}

import math

import numpy as np
import pytest
from helpers import Groups

from cohortmine.llm import rp_forest as rf


def _plain(rows, cosine=0.9):
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.linalg.norm(v) > 0 for _, v in rows]
    groups = Groups(range(len(rows)))
    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if ok[i] and ok[j] and len(a) == len(b) and np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                links[i] += 1
                links[j] += 1
                groups.join(i, j)
    least = {}
    for i, (v, _) in enumerate(rows):
        least[groups.find(i)] = min(least.get(groups.find(i), v), v)
    return sorted((v, links[i], least[groups.find(i)], least[groups.find(i)] == v) for i, (v, _) in enumerate(rows))


def _rows(seed, n=300, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    near = base[:80] + 0.12 * rng.standard_normal((80, dim))
    group = base[0] + 0.1 * rng.standard_normal((60, dim))
    x = [*base, *near, *group, *(3 * base[:5]), *base[10:20]]
    return [(i, [float(c) for c in v]) for i, v in enumerate(x)]


ODD = [(9001, None), (9002, []), (9003, [0.0] * 16), (9004, [1.0] * 15 + [None]), (9005, [math.nan] * 16),
       (9006, [math.inf] + [0.0] * 15), (9007, [1.0, 0.0]), (9008, [2.0, 0.1])]


def test_one_leaf_is_exact(spark):
    rows = _rows(1) + ODD
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in rf.near_vectors(df).collect()) == _plain(rows)


def test_forest_recall_and_no_false_link(spark):
    rows = _rows(2, n=600)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {r[0]: r for r in _plain(rows)}
    got = {r[0]: tuple(r) for r in rf.near_vectors(df, leaf=40).collect()}
    assert all(got[i][1] <= want[i][1] for i in want)
    assert sum(r[1] for r in got.values()) >= 0.9 * sum(r[1] for r in want.values())
    assert sum(got[i][2] == want[i][2] for i in want) >= 0.98 * len(want)


def test_recall_on_embeddings(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in rf.op10_embedding_dedup(spark, sf).collect())
    assert got == _plain(rows)


def test_no_split_while_a_leaf_holds_all():
    assert rf.shape_of_forest(10) == (1, 0)
    trees, depth = rf.shape_of_forest(10**9)
    assert depth > 20 and trees > 10


@pytest.mark.parametrize("copies", [1, 50])
def test_copies_count_as_links(spark, copies):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(copies)] + [(100, [2.0, 4.0]), (101, [-1.0, 2.0])], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rf.near_vectors(df).collect()}
    assert got[0] == (copies, 0, True) and got[100] == (copies, 0, False) and got[101] == (0, 101, True)


def test_group_of_many_leaves_keeps_its_links(spark):
    rng = np.random.default_rng(5)
    group = rng.standard_normal(16) + 0.22 * rng.standard_normal((2000, 16))
    x = np.vstack([rng.standard_normal((1000, 16)), group, group[:3]])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (u @ u.T >= 0.9).sum(axis=1) - 1
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in rf.near_vectors(df, leaf=20).collect()}
    have = np.array([got[i] for i in range(len(x))])
    assert want.sum() > 2_000_000
    assert (have <= want).all() and have.sum() >= 0.999 * want.sum()

"""Embedding near-dedup (operator 10): a forest of random-projection trees.

Each tree splits its nodes along random directions, level by level, at the median of the node's
own projections, with spill: rows between the ``0.5 - SPILL`` and ``0.5 + SPILL`` quantiles go to
both sides. The quantiles are aggregated from all rows. When nodes hold about ``LEAF`` rows, the
members of each leaf are compared in double precision, links are verified there and united by
distributed union-find. The number of trees follows from the depth so that a pair at the
threshold shares a leaf somewhere with probability ``RECALL``.

No pair is emitted: a leaf returns how many vectors each member links with and a spanning forest
of its links. A pair that meets in several leaves is counted in the first of them only; each row
carries the list of its leaves, so a leaf decides that by itself. Vectors of one direction (to
ten decimals) are one class with a multiplicity and are never compared with each other.

Inside a group larger than a leaf every split goes through the group, so a pair meets in a tree
with about leaf / group and the trees lose most of its links. The leaves do find that the group
is one component: the members of every component of ``leaf / DENSE_SHARE`` classes or more are
compared again, all pairs, block against block, and those counts take the place of the trees'.
A block is one row; strips of blocks are broadcast, so the pairs of blocks are never shuffled.

Defined cases: null, zero, empty vectors and vectors with null or non-finite components link
with nothing; vectors of different lengths do not link; repeated rows are separate vectors that
link; a null vec_id is never a component's least id unless all are null; an empty table gives no
rows; other columns are not read, clashing names give way to the result's.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmine.llm.common import checkpointed, read, written
from cohortmine.llm.components import components
from cohortmine.llm.simhash import _Forest

COSINE = 0.9
LEAF = 2000      # rows of a leaf, about
SPILL = 0.05     # of a node's rows on either side of its median
RECALL = 0.98    # of pairs at the threshold that should share a leaf
MIN_TREES = 4
DENSE_SHARE = 8  # components of an eighth of a leaf or more are counted exactly
BLOCK = 1000     # classes of a block, about
STRIP = 32       # blocks broadcast at a time
SEED = 29
_PAIRS = 1 << 18


def shape_of_forest(n: int, leaf: int = LEAF, spill: float = SPILL, cosine: float = COSINE,
                    recall: float = RECALL) -> tuple[int, int]:
    """(trees, depth) for n classes: one tree without splits while a leaf holds them all.

    A split parts a pair at the threshold with at most the probability angle / pi (no spill
    counted), so a tree keeps it together with (1 - angle / pi) ** depth at least; the spill
    makes up for rows near the threshold and halves the number of trees that would need.
    """
    if n <= leaf:
        return 1, 0
    depth = math.ceil(math.log(n / leaf) / -math.log(0.5 + spill))
    apart = math.acos(cosine) / math.pi * (1 - 4 * spill)
    together = (1 - apart) ** depth
    return max(MIN_TREES, math.ceil(math.log(1 - recall) / math.log(1 - together))), depth


def classes_of(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, cls, unit): every row; cls and unit are null for vectors that cannot link."""
    v = F.col(embedding).cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))  # null with a null component
    ok = v.isNotNull() & (F.size(v) > 0) & norm.isNotNull() & ~F.isnan(norm) & (norm > 0) & (norm < float("inf"))
    unit = F.when(ok, F.transform(v, lambda x: x / norm))
    named = rows.select(F.col(vec_id).alias("id"), unit.alias("unit"))
    return named.withColumn("cls", F.when(F.col("unit").isNotNull(), F.xxhash64(
        F.transform("unit", lambda x: F.round(x, 10) + F.lit(0.0)))))


def _project(frames: Iterator[pd.DataFrame], trees: int, depth: int, seed: int) -> Iterator[pd.DataFrame]:
    """One row a class and tree with its projections at all levels (directions by seed and length)."""
    drawn: dict[int, np.ndarray] = {}
    for f in frames:
        units = f["unit"].to_numpy()
        size = np.array([len(u) for u in units])
        for dim in np.unique(size):
            if dim not in drawn:
                drawn[dim] = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), trees * depth))
            at = np.flatnonzero(size == dim)
            p = np.vstack(units[at]) @ drawn[dim]
            cls = f["cls"].to_numpy()[at]
            yield pd.DataFrame({"cls": np.repeat(cls, trees), "tree": np.tile(np.arange(trees, dtype=np.int32), len(at)),
                                "node": np.ones(len(at) * trees, np.int64),
                                "p": list(p.reshape(len(at) * trees, depth))})


def leaves(classes: DataFrame, trees: int, depth: int, spill: float = SPILL, seed: int = SEED) -> DataFrame:
    """(cls, tree, node): the leaves of every class in every tree."""
    if depth == 0:
        return classes.select("cls", F.lit(0).alias("tree"), F.lit(1).cast("long").alias("node"))
    rows = checkpointed(classes.select("cls", "unit").mapInPandas(
        lambda it: _project(it, trees, depth, seed), "cls long, tree int, node long, p array<double>"))
    for level in range(depth):
        at = F.get("p", F.lit(level))
        cuts = rows.groupBy(F.col("tree").alias("t"), F.col("node").alias("m")).agg(
            F.percentile_approx(at, [0.5 - spill, 0.5 + spill], 2000).alias("q"))
        sides = F.array_compact(F.array(
            F.when(at <= F.get("q", F.lit(1)), F.col("node") * 2), F.when(at >= F.get("q", F.lit(0)), F.col("node") * 2 + 1)))
        rows = checkpointed(rows.join(cuts, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("m"))).select(
            "cls", "tree", F.explode(sides).alias("node"), "p"))
    return rows.select("cls", "tree", "node").distinct()


def _compare_leaf(cls: np.ndarray, units: np.ndarray, n: np.ndarray, lists: list, here: int,
                  cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(links of each member counted here, parent array of its links)."""
    m = len(cls)
    # Earlier leaves that at least two members share, as bits.
    flat = np.concatenate(lists)
    owner = np.repeat(np.arange(m), [len(x) for x in lists])
    before = flat < here
    codes, slot, count = np.unique(flat[before], return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    bits = np.zeros((m, max(1, int(shared.sum()))), bool)
    use = shared[slot]
    bits[owner[before][use], column[slot[use]]] = True
    packed = np.packbits(bits, axis=1)
    links = np.zeros(m, np.int64)
    forest = _Forest(m)
    step = max(1, _PAIRS // m)
    for lo in range(0, m, step):
        c = units[lo:lo + step] @ units[lo:].T
        i, j = np.nonzero(c >= cosine)
        i, j = i + lo, j + lo
        i, j = i[j > i], j[j > i]
        for k in range(0, len(i), _PAIRS):
            a, b = i[k:k + _PAIRS], j[k:k + _PAIRS]
            forest.union(a, b)
            new = ~(packed[a] & packed[b]).any(axis=1)
            a, b = a[new], b[new]
            links += np.bincount(a, weights=n[b], minlength=m).astype(np.int64)
            links += np.bincount(b, weights=n[a], minlength=m).astype(np.int64)
    return links, forest.parent


def _compare(frames: Iterator[pd.DataFrame], cosine: float) -> Iterator[pd.DataFrame]:
    """Members in the order of their leaves -> (a, links) sums and (a, b) forest edges."""

    def done(f: pd.DataFrame) -> pd.DataFrame:
        size = f["unit"].map(len).to_numpy()
        out = []
        for dim in np.unique(size):
            g = f[size == dim]
            if len(g) < 2:
                continue
            cls = g["cls"].to_numpy()
            links, parent = _compare_leaf(cls, np.vstack(g["unit"].to_numpy()), g["n"].to_numpy(),
                                          [np.asarray(x) for x in g["codes"]], int(g["code"].iloc[0]), cosine)
            at = np.flatnonzero(links)
            out.append(pd.DataFrame({"a": cls[at], "b": pd.array([None] * len(at), "Int64"), "links": links[at]}))
            at = np.flatnonzero(parent != np.arange(len(cls)))
            out.append(pd.DataFrame({"a": cls[at], "b": pd.array(cls[parent[at]], "Int64"), "links": np.zeros(len(at), np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "links": []})

    held: list[pd.DataFrame] = []
    for f in frames:
        while len(f):
            same = f["code"].to_numpy() == f["code"].iloc[0]
            end = len(f) if same.all() else int(np.argmin(same))
            if held and held[0]["code"].iloc[0] != f["code"].iloc[0]:
                yield done(pd.concat(held))
                held = []
            held.append(f.iloc[:end])
            f = f.iloc[end:]
    if held:
        yield done(pd.concat(held))


def _pack(f: pd.DataFrame) -> pd.DataFrame:
    """The members of one block as one row."""
    return pd.DataFrame({"root": f["root"].iloc[:1], "blocks": f["blocks"].iloc[:1], "block": f["block"].iloc[:1],
                         "members": [f["cls"].to_numpy()], "times": [f["n"].to_numpy()],
                         "units": [np.vstack(f["unit"].to_numpy()).tobytes()]})


def _compare_blocks(frames: Iterator[pd.DataFrame], cosine: float) -> Iterator[pd.DataFrame]:
    """Pairs of blocks -> (a, links): the links of the members of both, summed over the task."""
    found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def add(root: int, block: int, members: np.ndarray, links: np.ndarray) -> None:
        _, so_far = found.setdefault((root, block), (members, np.zeros(len(members))))
        so_far += links

    for f in frames:
        for x in f.itertuples():
            u = np.frombuffer(x.units).reshape(len(x.members), -1)
            v = np.frombuffer(x.units2).reshape(len(x.members2), -1)
            near = (u @ v.T >= cosine).astype(float)
            if x.block == x.block2:
                np.fill_diagonal(near, 0)
            else:
                add(x.root, x.block2, x.members2, near.T @ x.times)
            add(x.root, x.block, x.members, near @ x.times2)
    for members, links in found.values():
        yield pd.DataFrame({"a": members, "links": links.astype(np.int64)})


def dense_links(classes: DataFrame, roots: DataFrame, least: int, cosine: float = COSINE, block: int = BLOCK,
                strip: int = STRIP) -> DataFrame | None:
    """(a, links): exact links of the classes in components of ``least`` classes or more.

    Of two blocks i, j of a component's b the one from which the other is at most b / 2 ahead
    (cyclically) holds the pair, so every block has as many pairs as another.
    """
    large = checkpointed(roots.groupBy(F.col("root").alias("r")).agg(F.count("*").alias("size")).filter(F.col("size") >= least))
    if large.isEmpty():
        return None
    placed = roots.join(large, F.col("root") == F.col("r")).select("node", "root", F.ceil(F.col("size") / block).alias("blocks"))
    named = classes.join(placed, F.col("cls") == F.col("node")).select(
        "cls", "unit", "n", "root", "blocks", F.pmod(F.xxhash64("cls"), F.col("blocks")).alias("block"))
    packed = written(named.groupBy("root", "block").applyInPandas(
        _pack, "root long, blocks long, block long, members array<long>, times array<long>, units binary"))
    turn = F.pmod(F.xxhash64("root", "block"), F.lit(max(1, -(-packed.count() // strip))))
    strips = sorted(x[0] for x in packed.select(turn).distinct().collect())
    tasks = max(packed.sparkSession.sparkContext.defaultParallelism, len(strips))
    spread = packed.repartition(tasks)
    ahead = F.pmod(F.col("block2") - F.col("block"), F.col("blocks"))
    mine = (2 * ahead < F.col("blocks")) | ((2 * ahead == F.col("blocks")) & (F.col("block") < F.col("block2")))
    out = None
    for s in strips:
        other = packed.filter(turn == s).select(F.col("root").alias("root2"), F.col("block").alias("block2"), F.col("members").alias("members2"),
                                                F.col("times").alias("times2"), F.col("units").alias("units2"))
        pairs = spread.join(F.broadcast(other), (F.col("root") == F.col("root2")) & mine)
        part = checkpointed(pairs.mapInPandas(lambda it: _compare_blocks(it, cosine), "a long, links long")
                            .groupBy("a").agg(F.sum("links").alias("links")))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("a").agg(F.sum("links").alias("links"))


def near_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE,
                 leaf: int = LEAF, spill: float = SPILL, recall: float = RECALL, seed: int = SEED) -> DataFrame:
    """(vec_id, n_links, component_id, kept): a row a vector."""
    named = classes_of(rows, vec_id, embedding)
    own = written(named.select("id", "cls"))
    classes = written(named.filter(F.col("cls").isNotNull()).groupBy("cls").agg(
        F.min("unit").alias("unit"), F.count("*").alias("n")))
    trees, depth = shape_of_forest(classes.count(), leaf, spill, cosine, recall)
    code = F.shiftleft(F.col("tree").cast("long"), 48).bitwiseOR(F.col("node")).alias("code")
    placed = checkpointed(leaves(classes, trees, depth, spill, seed).select("cls", code))
    lists = placed.groupBy(F.col("cls").alias("lc")).agg(F.collect_list("code").alias("codes"))
    members = classes.join(lists, F.col("cls") == F.col("lc")).select(
        "cls", "unit", "n", "codes", F.explode("codes").alias("code"))
    found = written(members.repartition("code").sortWithinPartitions("code").mapInPandas(
        lambda it: _compare(it, cosine), "a long, b long, links long"))
    links = found.filter("b is null").groupBy(F.col("a").alias("la")).agg(F.sum("links").alias("links"))
    roots = components(found.filter("b is not null").select("a", "b"))
    exact = dense_links(classes, roots, max(2, leaf // DENSE_SHARE), cosine) if depth else None
    if exact is not None:
        links = links.join(exact.select(F.col("a").alias("ea"), F.col("links").alias("exact")), F.col("la") == F.col("ea"), "left").select(
            "la", F.coalesce("exact", "links").alias("links"))
    per_class = classes.select("cls", "n").join(links, F.col("cls") == F.col("la"), "left").join(
        roots, F.col("cls") == F.col("node"), "left").select(
        F.col("cls").alias("c"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("root", "cls").alias("root"))
    joined = own.join(per_class, F.col("cls") == F.col("c"), "left").select("id", "n_links", "root")
    least = joined.filter(F.col("root").isNotNull()).groupBy(F.col("root").alias("r")).agg(F.min("id").alias("least"))
    return joined.join(least, F.col("root") == F.col("r"), "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))

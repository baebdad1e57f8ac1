"""SimHash near-dedup (operator 2): fingerprints, a binary trie self-join, components.

Fingerprints are 64 majority bits over XXH64 hashes of 3-word shingles. Pairs within the bit
budget are found on four tries, one for each rotation of the fingerprint by 16 bits: two
fingerprints that differ in at most 3 bits agree on at least one whole 16-bit block, so in one
rotation they meet below the same 16-bit node. Below it, node pairs are traversed together, one
bit at a time, adding up differing bits and dropping a pair of nodes once its errors exceed the
budget. Work items are trie node pairs: a node with too many fingerprints is replaced by the
pairs of its children that are within the budget, until both sides fit a task.

A task returns only a spanning forest of the links it found, so groups of near copies never
turn into all their pairs, and equal fingerprints are collapsed to one before the join.

Defined cases: a null or wordless text has fingerprint zero and is linked like any other; fewer
words than a shingle make one shingle; rows that repeat a doc_id share its component; a null doc_id
is no smallest id: its component has the least other id, null if there is none; an empty
table gives no rows; other columns are not read, clashing names give way to the result's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmine.llm.common import checkpointed, own_columns, read, semi_or_anti, text_or_empty
from cohortmine.llm.components import components

SHINGLE = 3     # words
MAX_BITS = 3    # differing bits that still link
SEED = 42
NODE_LEAVES = 20_000   # fingerprints below one side of a work item
STRIDE = 4             # bits by which an oversized node is split
_BLOCK = 1 << 16       # shingles hashed at a time
_PAIRS = 1 << 19       # node pairs held at a time
_BATCH = 1 << 17       # fingerprints traversed at a time


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a whole text; ``bytes.lower``/``split`` are the ASCII rules asked for."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams: Iterator[bytes] = iter([b" ".join(words)])
        n = 1
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
        n = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _BLOCK):
        size = min(_BLOCK, n - at)
        h = np.fromiter((digest(next(grams), seed) for _ in range(size)), np.uint64, size)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, __t text hash, fp) for every row; ``fp`` is the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_or_empty(text)).alias("__t"),
                       fp(F.col(text).cast("string")).alias("fp"))


class _Forest:
    """Union-find over array positions, vectorised: hook roots on the lesser, then shorten."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.parent[a], self.parent[b]
            open_ = ra != rb
            if not open_.any():
                return
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.parent[self.parent]
                if (up == self.parent).all():
                    break
                self.parent = up


def traverse(values: np.ndarray, pairs: list[np.ndarray], max_bits: int) -> np.ndarray:
    """Walk pairs of trie nodes down to leaves; return the parent array of the links found.

    ``values`` are distinct-within-a-node fingerprints (uint64), each node a sorted range.
    ``pairs`` holds lo1, hi1, lo2, hi2: ranges that agree on their first 16 bits.
    """
    n = len(values)
    ones = [None] * 64
    forest = _Forest(n)
    stack = [(16, *pairs, np.zeros(len(pairs[0]), np.int8))]
    while stack:
        depth, lo1, hi1, lo2, hi2, err = stack.pop()
        if depth == 64:
            forest.union(lo1, lo2)
            continue
        if len(lo1) > _PAIRS:
            half = len(lo1) // 2
            stack.append((depth, lo1[:half], hi1[:half], lo2[:half], hi2[:half], err[:half]))
            stack.append((depth, lo1[half:], hi1[half:], lo2[half:], hi2[half:], err[half:]))
            continue
        if ones[depth] is None:
            bit = (values >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate(([0], np.cumsum(bit, dtype=np.int64)))
        c = ones[depth]
        mid1, mid2 = hi1 - (c[hi1] - c[lo1]), hi2 - (c[hi2] - c[lo2])
        self_ = lo1 == lo2
        other = ~self_
        out = [np.concatenate(x) for x in (
            (lo1, mid1, lo1, mid1[other]), (mid1, hi1, mid1, hi1[other]),
            (lo2, mid2, mid2, lo2[other]), (mid2, hi2, hi2, mid2[other]),
            (err, err, err + 1, err[other] + 1))]
        keep = (out[1] > out[0]) & (out[3] > out[2]) & (out[4] <= max_bits)
        keep &= (out[0] != out[2]) | (out[1] - out[0] > 1)  # a leaf with itself is done
        if keep.any():
            stack.append((depth + 1, *[x[keep] for x in out]))
    return forest.parent


def _links(frames: Iterator[pd.DataFrame], max_bits: int) -> Iterator[pd.DataFrame]:
    """Rows (work, side, rot, r) ordered by work, side, r -> forest edges (a, b) of fingerprints."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        # Unsigned order within a node: the sort key of the frame is the signed value.
        r = df["r"].to_numpy().view(np.uint64)
        work, side = df["work"].to_numpy(), df["side"].to_numpy()
        rot, top = df["rot"].to_numpy(), r >> np.uint64(48)
        order = np.lexsort((r, side, top, rot, work))  # the first block is part of the node
        r, work, side, rot, top = r[order], work[order], side[order], rot[order], top[order]
        node = np.r_[True, (work[1:] != work[:-1]) | (rot[1:] != rot[:-1]) | (top[1:] != top[:-1])]
        start = np.flatnonzero(node | np.r_[True, side[1:] != side[:-1]])
        end = np.r_[start[1:], len(r)]
        lone = side[start] == 0
        paired = np.r_[~node[start][1:], False]  # side 0 followed by side 1
        one = lone & ~paired
        lo1 = np.r_[start[one], start[paired]]
        hi1 = np.r_[end[one], end[paired]]
        nxt = np.flatnonzero(paired) + 1
        lo2, hi2 = np.r_[start[one], start[nxt]], np.r_[end[one], end[nxt]]
        parent = traverse(r, [lo1, hi1, lo2, hi2], max_bits)
        at = np.flatnonzero(parent != np.arange(len(r)))
        shift = (16 * rot).astype(np.uint64)
        back = np.where(shift == 0, r, (r >> shift) | (r << (np.uint64(64) - np.maximum(shift, np.uint64(1)))))
        return pd.DataFrame({"a": back[at].view(np.int64), "b": back[parent[at]].view(np.int64)})

    held: list[pd.DataFrame] = []
    rows = 0
    for frame in frames:
        if not len(frame):
            continue
        held.append(frame)
        rows += len(frame)
        last = frame["work"].iloc[-1]
        if rows >= _BATCH and (frame["work"].iloc[0] != last or held[0]["work"].iloc[0] != last):
            whole = pd.concat(held)
            rest = whole["work"].to_numpy() == last
            yield run(whole[~rest])
            held, rows = [whole[rest]], int(rest.sum())
    if held:
        yield run(pd.concat(held))


def _prefix(depth: int):
    return F.shiftrightunsigned("r", 64 - depth)


def work_items(rotated: DataFrame, max_bits: int, leaves: int = NODE_LEAVES) -> DataFrame:
    """(rot, fp, r) -> rows (work, side, rot, r): each fingerprint in the node pairs to traverse.

    Nodes of 16 bits are paired with themselves. A pair whose sides hold more than ``leaves``
    fingerprints is expanded by ``STRIDE`` bits to its children's pairs within the budget.
    """
    depth = 16
    sizes = rotated.groupBy("rot", _prefix(depth).alias("p")).agg(F.count("*").alias("n"))
    pairs = sizes.select("rot", "p", F.col("p").alias("q"), F.lit(0).alias("err"),
                         F.col("n").alias("np"), F.col("n").alias("nq"))
    pairs = pairs.filter("np > 1")
    done: list[DataFrame] = []
    while True:
        fits = pairs.filter((F.col("np") <= leaves) & (F.col("nq") <= leaves))
        both = F.explode(F.when(F.col("p") == F.col("q"), F.array(F.struct(F.lit(0).alias("side"), F.col("p").alias("node"))))
                         .otherwise(F.array(F.struct(F.lit(0).alias("side"), F.col("p").alias("node")),
                                            F.struct(F.lit(1).alias("side"), F.col("q").alias("node")))))
        items = fits.select(F.col("rot").alias("w_rot"), F.xxhash64("rot", F.lit(depth), "p", "q").alias("work"),
                            both.alias("x")).select("w_rot", "work", "x.side", "x.node")
        placed = rotated.withColumn("__p", _prefix(depth))
        done.append(placed.join(items, (F.col("rot") == F.col("w_rot")) & (F.col("__p") == F.col("node")))
                    .select("work", "side", "rot", "r"))
        large = pairs.filter((F.col("np") > leaves) | (F.col("nq") > leaves))
        if depth + STRIDE > 64 or large.isEmpty():
            break
        depth += STRIDE
        up = F.shiftrightunsigned("c", STRIDE)
        kids = rotated.groupBy("rot", _prefix(depth).alias("c")).agg(F.count("*").alias("n"))
        kp = kids.select(F.col("rot").alias("r1"), up.alias("u1"), F.col("c").alias("cp"), F.col("n").alias("n1"))
        kq = kids.select(F.col("rot").alias("r2"), up.alias("u2"), F.col("c").alias("cq"), F.col("n").alias("n2"))
        pairs = (large.join(kp, (F.col("rot") == F.col("r1")) & (F.col("p") == F.col("u1")))
                 .join(kq, (F.col("rot") == F.col("r2")) & (F.col("q") == F.col("u2")))
                 .filter((F.col("p") != F.col("q")) | (F.col("cp") < F.col("cq"))
                         | ((F.col("cp") == F.col("cq")) & (F.col("n1") > 1)))
                 .withColumn("e", F.col("err") + F.bit_count(
                     F.col("cp").bitwiseXOR(F.col("cq")).bitwiseAND(F.lit((1 << STRIDE) - 1))))
                 .filter(F.col("e") <= max_bits)
                 .select("rot", F.col("cp").alias("p"), F.col("cq").alias("q"), F.col("e").alias("err"),
                         F.col("n1").alias("np"), F.col("n2").alias("nq")))
        pairs = checkpointed(pairs)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def near_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS, leaves: int = NODE_LEAVES) -> DataFrame:
    """Distinct ``fp`` longs -> (node, root): components of those within ``max_bits`` of another.

    The four rotations find every pair for budgets up to 3 bits.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the four 16-bit blocks of a fingerprint cover at most 3 differing bits")
    turns = F.explode(F.array(*[F.lit(i) for i in range(4)]))
    rotated = fps.select("fp", turns.alias("rot")).select("rot", F.expr(
        "case rot when 0 then fp when 1 then shiftleft(fp, 16) | shiftrightunsigned(fp, 48)"
        " when 2 then shiftleft(fp, 32) | shiftrightunsigned(fp, 32)"
        " else shiftleft(fp, 48) | shiftrightunsigned(fp, 16) end").alias("r"))
    items = work_items(rotated, max_bits, leaves)
    dealt = items.repartition("work").sortWithinPartitions("work")
    edges = dealt.mapInPandas(lambda frames: _links(frames, max_bits), "a long, b long")
    return components(edges)


def near_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE,
                   max_bits: int = MAX_BITS, leaves: int = NODE_LEAVES) -> DataFrame:
    """(doc_id, __t, fp, root): every row with its fingerprint and its component's least one."""
    own = checkpointed(fingerprints(docs, text, doc_id, shingle))
    near = near_fingerprints(own.select("fp").distinct(), max_bits, leaves)
    return own.join(near, F.col("fp") == F.col("node"), "left").select(
        "doc_id", "__t", "fp", F.coalesce("root", "fp").alias("root"))


def simhash_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id): a row a document."""
    near = checkpointed(near_documents(docs, text, doc_id, **how))
    least = near.groupBy("root").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("root", "__root")
    return near.join(least, F.col("root") == F.col("__root")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """One row of every component: the least doc_id's, columns as they were."""
    near = checkpointed(near_documents(docs, text, doc_id, **how))
    first = near.groupBy("root").agg(F.min(F.struct("doc_id", "__t")).alias("x"), ).select(
        F.col("root").alias("__root"), F.col("x.doc_id").alias("__first"), F.col("x.__t").alias("__ft"))
    marked = near.join(first, F.col("root") == F.col("__root"))
    gone = marked.filter(~(F.col("doc_id").eqNullSafe(F.col("__first")) & (F.col("__t") == F.col("__ft"))))
    keyed = docs.withColumn("__t", F.xxhash64(text_or_empty(text))).withColumn("__id", F.col(doc_id))
    kept = semi_or_anti(keyed, gone.select(F.col("doc_id").alias("__id"), "__t"), ["__id", "__t"], "left_anti")
    again = near.groupBy("doc_id", "__t").count().filter("count > 1").select(F.col("doc_id").alias("__id"), "__t")
    again = checkpointed(again)
    if not again.isEmpty():  # rows that repeat both id and text
        single = semi_or_anti(kept, again, ["__id", "__t"], "left_anti")
        kept = single.unionByName(semi_or_anti(kept, again, ["__id", "__t"], "left_semi")
                                  .dropDuplicates(["__id", "__t"]))
    return kept.select(*own_columns(docs, ()))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))

"""Frequent itemsets, level by level (A5, A6, J3, J4, F4-F6, O6; H4).

Common steps: ``pairs`` = distinct ``(tid, item)`` (persisted), n = distinct tids,
``L_1`` = items with ``cnt/n > s``. Each level k >= 2 builds the apriori-gen
candidates from ``L_{k-1}`` (:func:`candidates`) and counts them with one of:

* ``bitmap`` (default): pairs are counted where they co-occur; from size 3 on every frequent
  itemset keeps a tid bitmap per tid group and a candidate's bitmap is the AND of its
  two parents' (:func:`_bitmap_levels`).
* ``tidjoin``: every transaction's frequent (k-1)-itemsets are extended by its later
  frequent items with an equi-join on ``tid`` (:func:`_tidjoin_levels`).
* ``vertical``: adaptive vertical sets of transaction groups, candidates counted along a
  broadcast prefix tree (:func:`_vertical_levels`).
* ``partition``: two passes without a level loop: every group mined by itself, the union of the
  results counted once (:func:`_partition_levels`).
* ``fpgrowth``: FP-growth over the baskets, then the same filters.

Counts aggregate map-side first, so a popular itemset costs one row per map task
in a shuffle. The driver keeps only the level counter and one row count per level
(the early stop of the reference loop, also used to size-check broadcasts). Every
``L_k`` (and the bitmaps a next level needs) is written with ``checkpoint()`` into
``spark.checkpoint.dir``, so the returned DataFrame depends on no cached block and
survives executor loss.
"""

from __future__ import annotations

import logging
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmine.functions import reference_count, support_passes
from cohortmine.operators.fpgrowth import frequent_sets
from cohortmine.operators.joins import BROADCAST_BYTES, broadcast_if, itemset_bytes
from cohortmine.operators.vertical import END, GROUP_TIDS, candidate_counts, local_itemsets, pair_counts, vertical_groups
from cohortmine.schemas import DEFAULT_MIN_SUPPORT, ITEMSET
from cohortmine.session import ensure_checkpoint_dir, held

_LOG = logging.getLogger(__name__)


def _int_id(c: Column) -> Column:
    """An integer id as INT; one that does not fit fails the query whatever the ANSI mode."""
    wide = c.cast("long")
    bad = F.raise_error(F.concat(F.lit("item id out of range: "), wide.cast("string")))
    return F.when(wide.between(-(1 << 31), (1 << 31) - 1), wide.cast("int")).when(
        wide.isNotNull(), bad.cast("int"))


def item_counts(tx: DataFrame, rows: bool = False, tid: str = "tid", item: str = "item") -> DataFrame:
    """A5: ``(item, cnt)``. Distinct transactions per item by default; ``rows=True``
    counts input rows (the reference's size-1 counting, D3)."""
    src = tx.select(F.col(tid).alias("tid"), _int_id(F.col(item)).alias("item"))
    if not rows:
        src = src.distinct()
    return src.groupBy("item").agg(F.count(F.lit(1)).alias("cnt"))


# Hash sub-groups per prefix class used to rank class members in parallel.
RANK_GROUPS = 16


def _ranked(df: DataFrame, key: str, val: str, groups: int = RANK_GROUPS) -> DataFrame:
    """Dense rank ``R`` (0-based) of ``val`` inside each ``key`` class plus the class size.

    Members are hashed into ``groups`` sub-groups and ranked inside them in
    parallel; a sub-group's offset is the summed size of the earlier sub-groups of
    its class. So no window covers a whole class, even when one class holds every
    frequent item (k = 2), and nothing is funnelled into a single partition.
    ``groups=1`` ranks with one window per class, for many small classes.
    """
    if groups <= 1:
        return df.select(key, val,
                         (F.row_number().over(Window.partitionBy(key).orderBy(val)) - 1).alias("R"),
                         F.count(F.lit(1)).over(Window.partitionBy(key)).alias("g"))
    d = df.select(key, val, F.pmod(F.xxhash64(val), F.lit(groups)).alias("h"))
    d = d.select(key, val, "h",
                 (F.row_number().over(Window.partitionBy(key, "h").orderBy(val)) - 1).alias("r"))
    sizes = d.groupBy(key, "h").agg(F.count(F.lit(1)).alias("gs"))
    # Every sub-group sends its size to all sub-groups of its class (groups^2 rows
    # per class at most); a hash aggregation sums, per receiving sub-group, the
    # sizes of the earlier ones (its offset) and of all of them (the class size).
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    spread = sizes.select(key, F.col("h").alias("src"), "gs", every.alias("h"))
    offs = spread.groupBy(key, "h").agg(
        F.sum(F.when(F.col("src") < F.col("h"), F.col("gs")).otherwise(F.lit(0))).alias("off"),
        F.sum("gs").alias("g"))
    return d.join(offs, [key, "h"]).select(key, val, (F.col("off") + F.col("r")).alias("R"), "g")


def candidates(itemsets: DataFrame, k: int, prune: bool = True) -> DataFrame:
    """J4 (apriori-gen): size-k candidates ``(items)`` from frequent (k-1)-itemsets.

    Two (k-1)-itemsets sharing their first k-2 items (their prefix class) and
    differing in the last one give one candidate, in one order only (no
    permutations, no repeated items). Members of a class get a dense rank R; the
    member of rank R pairs with ranks R+1 .. g-1 through ``explode(sequence)`` and an
    equi-join on (prefix, rank), so no cross or theta join is planned and the
    candidate rows are produced spread over tasks. With ``prune`` a candidate is
    kept only if all of its (k-1)-subsets are frequent.
    """
    if k < 2:
        raise ValueError("candidates need k >= 2")
    p = k - 2
    prev = itemsets.select(F.array_sort(F.col("items").cast("array<int>")).alias("items"))
    prefix = F.slice("items", 1, p) if p > 0 else F.array().cast("array<int>")
    base = prev.select(prefix.alias("prefix"), F.element_at("items", -1).alias("last")).distinct()
    # k = 2: one class holding every frequent item, ranked in hash sub-groups;
    # k >= 3: many classes of at most |L_1| members, one window each.
    ranked = _ranked(base, "prefix", "last", RANK_GROUPS if p == 0 else 1)
    left = ranked.filter(F.col("R") < F.col("g") - 1).select(
        "prefix", "last", F.explode(F.sequence(F.col("R") + 1, F.col("g") - 1)).alias("R"))
    right = ranked.select("prefix", "R", F.col("last").alias("other"))
    cand = left.join(right, ["prefix", "R"]).select(
        F.concat("prefix", F.array(F.least("last", "other"), F.greatest("last", "other")))
        .alias("items"))
    if not prune or k < 3:
        return cand
    # The two generators (drop one of the last two items) are frequent by
    # construction; check the k-2 other subsets.
    subs = cand.select("items", F.explode(F.sequence(F.lit(0), F.lit(k - 3))).alias("drop"))
    subs = subs.select("items", F.filter("items", lambda x, i: i != F.col("drop")).alias("sub"))
    present = subs.join(prev.select(F.col("items").alias("sub")), "sub", "left_semi")
    return (present.groupBy("items").agg(F.count(F.lit(1)).alias("hits"))
            .filter(F.col("hits") == k - 2).select("items"))


def cooccurring_pairs(tx: DataFrame) -> DataFrame:
    """J3 at k = 2: ``(items, cnt)`` of the item pairs that share a transaction.

    ``tx`` holds distinct ``(tid, item)`` rows. An equi-join on ``tid`` with ascending items,
    counted with partial sums: pairs that never occur together are never listed.
    """
    other = tx.select("tid", F.col("item").alias("other"))
    return (tx.join(other, "tid").filter(F.col("item") < F.col("other"))
            .groupBy("item", "other").agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.array("item", "other").alias("items"), "cnt"))


PAIR_SLOTS = 1 << 20


def frequent_pairs(tx: DataFrame, least: int, slots: int = PAIR_SLOTS) -> DataFrame:
    """``(items, cnt)`` of the pairs in at least ``least`` transactions, by hashed pair buckets first.

    A first pass counts pairs by the hash slot they fall into, a table of at most ``slots`` rows
    whatever the number of items; a pair in a slot counted less than ``least`` times cannot be
    frequent. The second pass shuffles and counts only pairs of the other slots, exactly. That pays
    where most pairs are rare: a pair then costs a partial count in a small table, not a group.
    ``tx`` holds distinct ``(tid, item)`` rows.
    """
    other = tx.select("tid", F.col("item").alias("other"))
    pairs = tx.join(other, "tid").filter(F.col("item") < F.col("other")).select(
        "item", "other", F.pmod(F.xxhash64("item", "other"), F.lit(slots)).cast("int").alias("slot"))
    hot = pairs.groupBy("slot").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= least).select("slot")
    # at most `slots` rows of one int: bounded by the parameter
    kept = pairs.join(F.broadcast(hot), "slot", "left_semi")
    return (kept.groupBy("item", "other").agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") >= least)
            .select(F.array("item", "other").alias("items"), "cnt"))


def frequent_itemsets(tx: DataFrame, min_support: float = DEFAULT_MIN_SUPPORT,
                      max_size: int | None = None, count_mode: str = "exact",
                      method: str = "bitmap", tid: str = "tid", item: str = "item",
                      broadcast_bytes: int = BROADCAST_BYTES, n: int | None = None,
                      ordered: bool = False) -> DataFrame:
    """H4: all frequent itemsets ``(items ARRAY<INT>, k INT, cnt BIGINT)``; see
    :func:`mine_itemsets`, which also returns the transaction count n. ``ordered`` sorts by
    size, falling count and items (O4)."""
    out = mine_itemsets(tx, min_support, max_size, count_mode, method, tid, item, broadcast_bytes, n)[0]
    return out.orderBy("k", F.desc("cnt"), "items") if ordered else out


def least_count(n: int, min_support: float, count_mode: str = "exact") -> int:
    """The least count of n transactions that passes ``min_support`` (n + 1 if none does)."""
    def passes(c: int) -> bool:
        ratio = c / n
        return (float(np.float32(ratio)) if count_mode == "reference" else ratio) > min_support

    low, high = 0, n + 1  # passes is monotone: false at 0 or below, taken as true at n + 1
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if passes(mid) else (mid, high)
    return high


METHODS = ("bitmap", "vertical", "partition", "tidjoin", "fpgrowth")


def mine_itemsets(tx: DataFrame, min_support: float = DEFAULT_MIN_SUPPORT,
                  max_size: int | None = None, count_mode: str = "exact",
                  method: str = "bitmap", tid: str = "tid", item: str = "item",
                  broadcast_bytes: int = BROADCAST_BYTES, n: int | None = None,
                  cache_levels: bool = False) -> tuple[DataFrame, int]:
    """H4: ``(itemsets, n)``; itemsets are ``(items ARRAY<INT>, k INT, cnt BIGINT)``.

    ``min_support`` is relative and strict (``cnt/n > min_support``); ``n`` is the
    number of distinct transactions. ``max_size`` bounds the itemset size (None: until
    a level is empty). ``count_mode='reference'`` counts single items by rows of ``tx``
    (repeated rows count again, D3), reports ``floor(cnt/(k-1)!)`` for k >= 2 and compares
    a 32-bit float quotient, as the reference does (D1, D2). Rows with a NULL tid or item
    name no membership and are left out, of n too; item ids outside INT fail the query.

    ``method`` picks how level k >= 2 is counted; all give the same result:

    * ``'bitmap'`` (default; alias ``'levelwise'``): vertical tid bitmaps, see
      :func:`_bitmap_levels`. ``cache_levels`` caches a level's AND results instead of
      writing them to a checkpoint; the columnar cache packs about 10,000 of these 4 KiB
      rows a task, so it wants 1 GiB of heap for each task slot.
    * ``'vertical'``: tid lists, diffsets or bitmaps, whichever is smallest, see
      :func:`_vertical_levels`.
    * ``'partition'``: two passes, see :func:`_partition_levels`.
    * ``'tidjoin'``: per-transaction extension join, see :func:`_tidjoin_levels`.
    * ``'fpgrowth'``: FP-growth over blocks of weighted paths, then the strict / reference
      filter, see :mod:`cohortmine.operators.fpgrowth`.
    """
    if method == "levelwise":
        method = "bitmap"
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}")
    if max_size is not None and max_size < 1:
        raise ValueError("max_size must be at least 1")
    if not isinstance(tx.schema[item].dataType, T.IntegralType):
        raise TypeError(f"column {item!r} must hold integer item ids, got "
                        f"{tx.schema[item].dataType.simpleString()} (map labels to ids first, "
                        "or use fp_itemsets for arbitrary item types)")
    spark = tx.sparkSession
    ensure_checkpoint_dir(spark)
    rows = (tx.select(F.col(tid).alias("tid"), _int_id(F.col(item)).alias("item"))
            .filter(F.col("tid").isNotNull() & F.col("item").isNotNull()))
    # Reference mode counts single items by rows: one held table has the pairs and their rows.
    reference = count_mode == "reference"
    once = rows.groupBy("tid", "item").agg(F.count(F.lit(1)).alias("c")) if reference else rows.distinct()
    with held(once) as table:
        pairs = table.select("tid", "item")
        if n is None:
            n = pairs.select("tid").distinct().count()
        if n == 0:
            return spark.createDataFrame([], ITEMSET), 0

        def passes(c):
            return support_passes(c, n, min_support, count_mode)

        single = F.sum("c") if reference else F.count(F.lit(1))
        l1, m1 = _checkpoint_counted(table.groupBy("item").agg(single.alias("cnt"))
                                     .filter(passes(F.col("cnt"))))
        levels = [l1.select(F.array("item").alias("items"), F.lit(1).alias("k"),
                            F.col("cnt").cast("long").alias("cnt"))]
        if m1 >= 2 and (max_size is None or max_size >= 2):
            f = pairs.join(broadcast_if(l1.select("item"), m1 * itemset_bytes(1) <= broadcast_bytes), "item",
                           "left_semi").select("tid", "item")
            if method == "fpgrowth":
                levels += _fpgrowth_levels(f, n, min_support, max_size, count_mode, passes, broadcast_bytes)
            elif method == "vertical":
                levels += _vertical_levels(f, n, max_size, count_mode, passes, broadcast_bytes)
            elif method == "partition":
                levels += _partition_levels(f, n, min_support, max_size, count_mode, passes, broadcast_bytes)
            elif method == "bitmap":
                levels += _bitmap_levels(f, n, m1, max_size, count_mode, passes, broadcast_bytes, cache_levels)
            else:
                levels += _tidjoin_levels(f, m1, max_size, count_mode, passes, broadcast_bytes)
        return reduce(DataFrame.unionByName, levels), n


def _checkpoint_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """Reliable checkpoint of ``df`` and its row count, observed in the same job.

    A retried task can only over-count, which at worst costs one empty extra level
    or a shuffle instead of a broadcast; results stay exact.
    """
    obs = Observation()
    out = df.observe(obs, F.count(F.lit(1)).alias("rows")).checkpoint()
    return out, int(obs.get["rows"])


def _drop_checkpoint(df: DataFrame | None) -> None:
    """Delete the files of an intermediate checkpoint nothing references any more
    (an earlier level's bitmaps or occurrences). Files left behind do not change a result;
    a failed deletion is logged with their place."""
    if df is None:
        return
    place = "an unknown place"
    try:
        plan = df._jdf.queryExecution().logical()
        ckpt = plan.rdd().getCheckpointFile()
        if ckpt.isDefined():
            place = ckpt.get()
            jvm = df.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(place)
            conf = df.sparkSession._jsc.hadoopConfiguration()
            path.getFileSystem(conf).delete(path, True)
    except Exception as exc:  # noqa: BLE001 - cleanup must never fail the job
        _LOG.warning("checkpoint files at %s were not deleted: %s", place, exc)


def _level(lk: DataFrame, k: int) -> DataFrame:
    return lk.select("items", F.lit(k).alias("k"), F.col("cnt").cast("long").alias("cnt"))


def _count_col(cnt: Column, k: int, count_mode: str) -> Column:
    return reference_count(cnt, k) if count_mode == "reference" else cnt


# ---- vertical bitmaps -------------------------------------------------------------

# Spark's bitmap functions use fixed 32768-bit (4 KiB) buckets. Transactions are
# hashed into groups of about TIDS_PER_BUCKET and numbered densely inside a group,
# so each group fills one bitmap bucket (rarely two).
BITMAP_BYTES = 4096
TIDS_PER_BUCKET = 24576
# Previous-level bitmaps up to this many bytes are broadcast and the work is split by
# candidate; above it the candidate table is broadcast to the bitmaps instead.
BITMAP_BROADCAST_BYTES = 64 * 1024 * 1024
# Tid groups that share a salt in the (rare) join of large bitmaps with a candidate table
# too big to broadcast: the salts grow with the groups, a (parent, salt) key does not.
GROUPS_PER_SALT = 64


def _bitmap_levels(f: DataFrame, n: int, m1: int, max_size: int | None, count_mode: str,
                   passes, broadcast_bytes: int, cache_levels: bool) -> list[DataFrame]:
    """Levels k >= 2 over tid bitmaps (Eclat-style vertical layout, built-ins only).

    Size 2 is counted from co-occurring pairs (:func:`cooccurring_pairs`); bitmaps start with
    the frequent pairs. Every frequent itemset X keeps ``(items, bucket, bm)``: the bitmap of the
    transactions holding X, one row per tid bucket with any hit. A size-k candidate
    (apriori-gen) has two frequent parents -- itself without its last item and
    without its second-to-last -- and its bitmap is their AND
    (``bitmap_and_agg`` over the two parent rows of each (candidate, bucket)); its
    support is the summed ``bitmap_count``. The work is |C_k| x buckets, whatever
    the basket sizes; a transaction with very many rows is still one bit per item,
    and buckets are uniform by construction, so no key is hot.
    """
    buckets = max(1, -(-n // TIDS_PER_BUCKET))
    parallelism = f.sparkSession.sparkContext.defaultParallelism
    hb = F.pmod(F.xxhash64("tid"), F.lit(buckets))
    pairs_only = max_size == 2
    l2, m2 = _checkpoint_counted(
        cooccurring_pairs(f).select("items", _count_col(F.col("cnt"), 2, count_mode).alias("cnt"))
        .filter(passes(F.col("cnt"))))
    if m2 == 0:
        _drop_checkpoint(l2)
        return []
    if pairs_only or m2 < 2:
        return [_level(l2, 2)]
    # Rank of a tid among the distinct tids of its hash group: deterministic, so a recomputed
    # task assigns the same positions. The window sees one row a transaction (its frequent
    # items, at most |L_1|), about TIDS_PER_BUCKET of them.
    gid = F.col("hb") * F.lit(1 << 31) + F.row_number().over(Window.partitionBy("hb").orderBy("tid"))
    carts = f.groupBy("tid").agg(F.collect_set("item").alias("own")).select("tid", "own", hb.alias("hb"))
    pos = carts.select("own", "hb", gid.alias("gid")).select(F.explode("own").alias("item"), "hb", "gid")
    # bucket is a function of hb; keeping hb in the key lets every bitmap aggregation
    # reuse the hb partitioning of the window instead of shuffling 4 KiB rows.
    bm = (pos.groupBy(F.array("item").alias("items"), "hb",
                      F.bitmap_bucket_number("gid").alias("bucket"))
          .agg(F.bitmap_construct_agg(F.bitmap_bit_position("gid")).alias("bm"))
          .checkpoint())
    bm_file = bm  # the checkpoint behind the current bitmaps
    prev_rows, out, k = m1, [], 2
    while (max_size is None or k <= max_size) and prev_rows >= 2:
        par_ckpt = None
        cand = l2.select("items") if k == 2 else candidates(prev, k)
        parents = F.array(F.slice("items", 1, k - 1),
                          F.concat(F.slice("items", 1, k - 2), F.array(F.element_at("items", -1))))
        par = cand.select("items", F.explode(parents).alias("parent"))
        side = bm.withColumnRenamed("items", "parent")
        if prev_rows * buckets * BITMAP_BYTES <= BITMAP_BROADCAST_BYTES:
            # Small previous level: broadcast its bitmaps, spread candidates.
            rows = par.repartition("items").join(broadcast_if(side, True), "parent")
        else:
            # Large: bitmaps stay where they are (partitioned by tid hash group, the
            # aggregation key includes hb); the candidate table travels.
            small = (2 * m2 if k == 2 else prev_rows * m1 * 2) * itemset_bytes(k, 2) <= broadcast_bytes
            if not small:
                par, par_rows = _checkpoint_counted(par)
                par_ckpt = par
                small = par_rows * itemset_bytes(k, 2) <= broadcast_bytes
            if small:
                if buckets >= parallelism:
                    # A checkpoint forgets its partitioning: re-partition the previous
                    # level's bitmaps by hash group (|L_{k-1}| rows) so that the join
                    # output already satisfies the (items, hb, bucket) aggregation and
                    # the 2*|C_k| joined bitmap rows never shuffle.
                    side = side.repartition("hb")
                # Fewer groups than task slots: the planner shuffles the joined rows by
                # (items, hb, bucket) instead, which spreads the AND work over all slots.
                rows = side.join(broadcast_if(par, True), "parent")
            else:
                # Both sides big: salt by tid group so one parent's bitmaps spread over
                # tasks of GROUPS_PER_SALT groups (each candidate row is replicated per salt).
                salts = max(1, -(-buckets // GROUPS_PER_SALT))
                salted = side.withColumn("salt", F.pmod(F.col("hb"), F.lit(salts)))
                par_s = par.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
                rows = salted.join(par_s, ["parent", "salt"]).drop("salt")
        # Written with checkpoint(), which streams rows to files, or cached if the caller
        # said so. On a known last level nothing is kept.
        anded = (rows.groupBy("items", "hb", "bucket")
                 .agg(F.bitmap_and_agg("bm").alias("bm"), F.count(F.lit(1)).alias("c"))
                 .filter(F.col("c") == 2)
                 .select("items", "hb", "bucket", "bm", F.bitmap_count("bm").alias("bits"))
                 .filter(F.col("bits") > 0))
        last = max_size is not None and k == max_size
        anded_ckpt = cached = None
        if last:
            src = anded
        elif cache_levels:
            src = cached = anded.persist()
        else:
            src = anded_ckpt = anded.checkpoint()
        try:
            if k == 2:
                lk, mk = l2, m2
            else:
                cnt = src.groupBy("items").agg(F.sum("bits").cast("long").alias("cnt"))
                lk, mk = _checkpoint_counted(
                    cnt.select("items", _count_col(F.col("cnt"), k, count_mode).alias("cnt"))
                    .filter(passes(F.col("cnt"))))
            if mk == 0:
                _drop_checkpoint(anded_ckpt)
                _drop_checkpoint(lk)
                break
            out.append(_level(lk, k))
            if last or mk < 2:
                _drop_checkpoint(anded_ckpt)
                break
            # Bitmaps of the frequent k-itemsets for the next level: written out when
            # cached (before the cache goes), else read lazily from this level's file.
            new_bm = src.join(broadcast_if(lk.select("items"), mk * itemset_bytes(k) <= broadcast_bytes),
                              "items", "left_semi").select("items", "hb", "bucket", "bm")
            if cached is not None:
                new_bm = anded_ckpt = new_bm.checkpoint()
        finally:
            if cached is not None:
                cached.unpersist()
            _drop_checkpoint(par_ckpt)
        _drop_checkpoint(bm_file)  # the previous level's bitmaps are no longer needed
        bm, bm_file = new_bm, anded_ckpt
        prev, prev_rows = lk.select("items"), mk
        k += 1
    _drop_checkpoint(bm_file)
    return out


# ---- vertical sets of transaction groups -------------------------------------------

# Bytes of a candidate in the broadcast prefix tree, beside 8 a item (int64 rows).
CANDIDATE_BYTES = 24
# Partition mining asks for this many transactions of an itemset in a group at least; below, a
# group's own mining would list chance combinations and the level loop is used instead.
LOCAL_LEAST = 8


def _group_number(n: int, parallelism: int, smallest: int = 2048) -> int:
    """Groups of at most GROUP_TIDS transactions, on small data enough to use every slot."""
    return max(-(-n // GROUP_TIDS), min(parallelism, -(-n // smallest)), 1)


def _counted(groups: DataFrame, cand: DataFrame, rows: int, width: int, broadcast_bytes: int) -> DataFrame:
    """(items, cnt) of candidates over all groups, by prefix trees that fit the broadcast bound.

    Candidates beyond the bound are split by the hash of all their items but the last, so the
    members of a prefix class stay together; every part is one pass over the groups.
    """
    parts = max(1, -(-rows * (CANDIDATE_BYTES + 8 * width) // broadcast_bytes))
    out = None
    for part in range(parts):
        mine = cand if parts == 1 else cand.filter(
            F.pmod(F.xxhash64(F.slice("items", 1, F.size("items") - 1)), F.lit(parts)) == part)
        lists = mine.select("items").toArrow().column(0).combine_chunks()  # rows / parts of them: bounded
        if not len(lists):
            continue
        sizes = np.diff(lists.offsets.to_numpy())
        tree = np.full((len(lists), int(sizes.max())), END, np.int64)
        tree[np.arange(tree.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
        found = candidate_counts(groups, tree)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else cand.sparkSession.createDataFrame([], "items array<int>, cnt long")


def _vertical_levels(f: DataFrame, n: int, max_size: int | None, count_mode: str, passes,
                     broadcast_bytes: int) -> list[DataFrame]:
    """Levels k >= 2 over :func:`cohortmine.operators.vertical.vertical_groups`.

    The groups are written once and never shuffled again: a level broadcasts its candidates as a
    prefix tree (bytes checked, in parts beyond the bound), tasks walk it with their groups' sets
    and send one row a candidate. No level's sets are written, those of a prefix are made anew on
    the way down. Pairs need no candidates: those that co-occur are counted.
    """
    groups = vertical_groups(f, _group_number(n, f.sparkSession.sparkContext.defaultParallelism))
    out, k, found = [], 2, pair_counts(groups)
    try:
        while True:
            lk, mk = _checkpoint_counted(found.select("items", _count_col(F.col("cnt"), k, count_mode).alias("cnt"))
                                         .filter(passes(F.col("cnt"))))
            if mk == 0:
                _drop_checkpoint(lk)
                break
            out.append(_level(lk, k))
            if k == max_size or mk < 2:
                break
            k += 1
            cand, rows = _checkpoint_counted(candidates(lk, k))
            if rows == 0:
                _drop_checkpoint(cand)
                break
            found = _counted(groups, cand, rows, k, broadcast_bytes)
    finally:
        _drop_checkpoint(groups)
    return out


def _partition_levels(f: DataFrame, n: int, min_support: float, max_size: int | None, count_mode: str,
                      passes, broadcast_bytes: int) -> list[DataFrame]:
    """Sizes k >= 2 in two passes: groups mined by themselves, their union counted over all.

    An itemset of at least ``c`` of n transactions has its share of c in some group, so the union
    holds every frequent itemset; one pass with exact counts drops the others. A task's memory is
    one group and one path of its prefix classes. Where the share of a group is fewer than
    ``LOCAL_LEAST`` transactions the level loop counts instead.
    """
    least = least_count(n, min_support, count_mode)
    parallelism = f.sparkSession.sparkContext.defaultParallelism
    number = _group_number(n, min(parallelism, max(1, least // (8 * LOCAL_LEAST))))
    if number > 1 and least // number < LOCAL_LEAST:
        return _vertical_levels(f, n, max_size, count_mode, passes, broadcast_bytes)
    groups = vertical_groups(f, number)
    local = local_itemsets(groups, least, n, max_size)
    union, rows = _checkpoint_counted(local.groupBy("items").agg(F.sum("cnt").alias("cnt"), F.count(F.lit(1)).alias("in_groups")))
    if number == 1 and groups.select("g").distinct().count() == 1:
        counted = union  # one group: its counts are the counts
    else:
        width = union.agg(F.max(F.size("items"))).first()[0] or 2
        counted = _counted(groups, union, rows, width, broadcast_bytes)
    k = F.size("items")
    count = F.col("cnt") if count_mode == "exact" else F.call_function(
        "div", F.col("cnt"), F.call_function("factorial", k - 1))
    out = counted.select("items", k.alias("k"), count.cast("long").alias("cnt")).filter(passes(F.col("cnt"))).checkpoint()
    _drop_checkpoint(groups)
    return [out]


# ---- per-transaction extension join ------------------------------------------------

def _tidjoin_levels(f: DataFrame, m1: int, max_size: int | None, count_mode: str, passes,
                    broadcast_bytes: int) -> list[DataFrame]:
    """Levels k >= 2 by extending each transaction's frequent (k-1)-itemsets.

    ``occ`` holds one ``(tid, items)`` row per transaction and frequent itemset it
    contains; level k joins it with the transaction's frequent items on ``tid`` with
    ``item > last(items)``, so every k-itemset is generated once per containing
    transaction; ``groupBy(items).count()`` (partial aggregation first) is the
    support. Cheap for short baskets; its rows grow with C(basket size, k).
    """
    # Partitioned by tid once and cached (a cache keeps its partitioning), so the
    # per-level joins on tid only shuffle the occurrence side.
    f = f.repartition("tid").persist()
    nxt = f.select("tid", F.col("item").alias("nxt"))
    occ = f.select("tid", F.array("item").alias("items"))
    occ_ckpt = None  # set once occ is a checkpoint of ours
    prev = occ.select("items").distinct()
    prev_rows, out, k = m1, [], 2
    try:
        while (max_size is None or k <= max_size) and prev_rows >= 2:
            cand_ckpt = None
            ext = (occ.join(nxt, "tid")
                   .filter(F.col("nxt") > F.element_at("items", -1))
                   .select("tid", F.concat("items", F.array("nxt")).alias("items")))
            if k >= 3:
                # |C_k| <= |L_{k-1}| * |L_1| is a proven bound; count only beyond it.
                cand = candidates(prev, k)
                small = prev_rows * m1 * itemset_bytes(k) <= broadcast_bytes
                if not small:
                    cand, cand_rows = _checkpoint_counted(cand)
                    cand_ckpt = cand
                    small = cand_rows * itemset_bytes(k) <= broadcast_bytes
                ext = ext.join(broadcast_if(cand, small), "items", "left_semi")
            # ext is never cached (it is the largest table of the level): the counts
            # aggregate it as it streams out of the join, and the frequent occurrences
            # are written once for the next level, at the price of running the join twice.
            cnt = ext.groupBy("items").agg(F.count(F.lit(1)).alias("cnt"))
            lk, mk = _checkpoint_counted(
                cnt.select("items", _count_col(F.col("cnt"), k, count_mode).alias("cnt"))
                .filter(passes(F.col("cnt"))))
            if mk == 0:
                _drop_checkpoint(cand_ckpt)
                _drop_checkpoint(lk)
                break
            out.append(_level(lk, k))
            if (max_size is not None and k == max_size) or mk < 2:
                _drop_checkpoint(cand_ckpt)
                break
            new_occ = ext.join(broadcast_if(lk.select("items"), mk * itemset_bytes(k) <= broadcast_bytes), "items",
                               "left_semi").checkpoint()
            _drop_checkpoint(cand_ckpt)
            _drop_checkpoint(occ_ckpt)  # the previous level's occurrences
            occ = occ_ckpt = new_occ
            prev, prev_rows = lk.select("items"), mk
            k += 1
    finally:
        f.unpersist()
        _drop_checkpoint(occ_ckpt)
    return out


# ---- FP-growth ------------------------------------------------------------------------

def _fpgrowth_levels(f: DataFrame, n: int, min_support: float, max_size: int | None,
                     count_mode: str, passes, broadcast_bytes: int) -> list[DataFrame]:
    """Sizes k >= 2 by FP-growth on the baskets, then the strict (or reference) filter.

    FP-growth's bound is inclusive: the least count that passes. In reference mode
    ``floor(cnt/(k-1)!) <= cnt`` keeps its output a superset.
    """
    bask = f.groupBy("tid").agg(F.collect_set("item").alias("items"))  # at most |L_1| items
    its = frequent_sets(bask, least_count(n, min_support, count_mode), max_size=max_size,
                        broadcast_bytes=broadcast_bytes).filter(F.col("k") >= 2)
    if count_mode == "reference":
        its = its.withColumn("cnt", F.call_function(
            "div", F.col("cnt"), F.call_function("factorial", F.col("k") - 1)))
    return [its.filter(passes(F.col("cnt"))).select(
        "items", F.col("k").cast("int").alias("k"), F.col("cnt").cast("long").alias("cnt")).checkpoint()]

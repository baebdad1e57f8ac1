"""Frequent itemsets with their negative border: verified samples and arriving batches.

The *tracked* sets are every single item, all frequent itemsets and the negative border: the
infrequent itemsets whose subsets are all frequent, so the candidates that a level loop would count
in vain. Whoever knows the counts of some sets can tell from them which candidates of the true
levels are still unknown (:func:`complete_levels`); only these need a pass over the transactions.
Two miners use it:

* :func:`sampled_itemsets` mines a sample of the transactions at a lowered support, counts the
  result and its border on all of them in one pass, and counts on only where a border set turns
  out frequent.
* :func:`update_itemsets` keeps the tracked sets of all batches so far: a batch is counted by
  itself, and only candidates above newly frequent border sets are recounted over the stored
  transactions.

Both are exact. The tracked pairs are at most ``|L1| ** 2 / 2``, those that never occur included.
"""

from __future__ import annotations

import math
import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmine.operators.itemsets import (
    _checkpoint_counted,
    _counted,
    _drop_checkpoint,
    _group_number,
    _int_id,
    candidates,
    least_count,
    mine_itemsets,
)
from cohortmine.operators.joins import BROADCAST_BYTES
from cohortmine.operators.vertical import vertical_groups
from cohortmine.schemas import DEFAULT_MIN_SUPPORT, ITEMSET
from cohortmine.session import ensure_checkpoint_dir

Count = Callable[[DataFrame, int, int], DataFrame]  # (sets, how many, longest) -> (items, cnt) of those met


def complete_levels(singles: DataFrame, known: DataFrame, least: int, max_size: int | None,
                    count: Count) -> tuple[DataFrame, int]:
    """``(tracked, passes)``: the tracked sets ``(items, k, cnt)``, and how many levels had unknown sets.

    ``singles`` and ``known`` hold exact counts, of every item and of any larger sets. ``count``
    counts the candidates that ``known`` lacks. Known sets that are no candidates are left out.
    """
    tracked, frequent, passes, k = [singles], singles.filter(F.col("cnt") >= least), 0, 1
    while max_size is None or k < max_size:
        k += 1
        cand, rows = _checkpoint_counted(candidates(frequent, k))
        if rows == 0:
            break
        here = known.filter(F.col("k") == k)
        level = here.join(cand, "items", "left_semi").select("items", "k", "cnt")
        unknown, many = _checkpoint_counted(cand.join(here, "items", "left_anti"))
        if many:
            passes += 1
            found = unknown.join(count(unknown, many, k), "items", "left")
            level = level.unionByName(found.select("items", F.lit(k).alias("k"), F.coalesce("cnt", F.lit(0)).cast("long").alias("cnt")))
        level = level.checkpoint()
        _drop_checkpoint(cand)
        _drop_checkpoint(unknown)
        tracked.append(level)
        frequent = level.filter(F.col("cnt") >= least)
    return reduce(DataFrame.unionByName, tracked), passes


class _Counter:
    """Counts sets over distinct (tid, item) rows; their groups are made at the first need."""

    def __init__(self, pairs: DataFrame, n: int, broadcast_bytes: int = BROADCAST_BYTES) -> None:
        self.pairs, self.n, self.bytes, self.groups = pairs, n, broadcast_bytes, None

    def __call__(self, sets: DataFrame, rows: int, width: int) -> DataFrame:
        if self.groups is None:
            parallelism = self.pairs.sparkSession.sparkContext.defaultParallelism
            self.groups = vertical_groups(self.pairs, _group_number(max(self.n, 1), parallelism))
        return _counted(self.groups, sets, rows, width, self.bytes)

    def close(self) -> None:
        _drop_checkpoint(self.groups)


def _pairs(tx: DataFrame, tid: str, item: str) -> DataFrame:
    return (tx.select(F.col(tid).alias("tid"), _int_id(F.col(item)).alias("item"))
            .filter(F.col("tid").isNotNull() & F.col("item").isNotNull()).distinct())


def _singles(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("item").agg(F.count(F.lit(1)).alias("cnt")).select(
        F.array("item").alias("items"), F.lit(1).alias("k"), "cnt")


def _having(pairs: DataFrame, singles: DataFrame, least: int) -> DataFrame:
    """The rows of frequent items."""
    items = singles.filter(F.col("cnt") >= least).select(F.element_at("items", 1).alias("item"))
    return pairs.join(items, "item", "left_semi").select("tid", "item")


# ---- sampling -----------------------------------------------------------------------

SAMPLE_FRACTION = 0.1
MISS_CHANCE = 0.01  # aimed at for one set, by Hoeffding's bound
_PARTS = 1_000_000


def sampled_itemsets(tx: DataFrame, min_support: float = DEFAULT_MIN_SUPPORT, max_size: int | None = None,
                     fraction: float = SAMPLE_FRACTION, seed: int = 17, lowered: float | None = None,
                     tid: str = "tid", item: str = "item") -> tuple[DataFrame, int, int]:
    """``(itemsets, n, passes)``: the result of :func:`mine_itemsets`, by a sample and its border.

    Transactions are sampled by a hash of their id. The sample is mined at ``lowered`` support (by
    default as much below ``min_support`` as a sample of that size may err, at least half of it).
    One pass over all transactions counts what it found and the border around that. ``passes`` is
    how many levels had to be counted further, 0 where the sample missed nothing.
    """
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be above 0, at most 1")
    spark = tx.sparkSession
    ensure_checkpoint_dir(spark)
    pairs = _pairs(tx, tid, item).checkpoint()
    n = pairs.select("tid").distinct().count()
    if n == 0:
        return spark.createDataFrame([], ITEMSET), 0, 0
    least = least_count(n, min_support)
    singles = _singles(pairs).checkpoint()
    if max_size == 1:
        return singles.filter(F.col("cnt") >= least), n, 0
    rows = _having(pairs, singles, least).checkpoint()
    drawn = rows.filter(F.pmod(F.xxhash64(F.lit(seed), F.col("tid")), F.lit(_PARTS)) < int(fraction * _PARTS))
    # The sampled transactions without a frequent item belong to the sample as well.
    size = pairs.filter(F.pmod(F.xxhash64(F.lit(seed), F.col("tid")), F.lit(_PARTS)) < int(fraction * _PARTS)).select("tid").distinct().count()
    counter = _Counter(rows, n)
    try:
        known = spark.createDataFrame([], ITEMSET)
        if size:
            if lowered is None:
                lowered = max(min_support / 2, min_support - math.sqrt(math.log(1 / MISS_CHANCE) / (2 * size)))
            guess, _ = mine_itemsets(drawn, lowered, max_size, method="partition", n=size)
            guess = guess.select("items", "k").checkpoint()
            known = _verified(guess, singles, least, max_size, counter)
        tracked, passes = complete_levels(singles, known, least, max_size, counter)
    finally:
        counter.close()
    return tracked.filter(F.col("cnt") >= least), n, passes


def _verified(guess: DataFrame, singles: DataFrame, least: int, max_size: int | None, counter: _Counter) -> DataFrame:
    """``(items, k, cnt)`` over all transactions of the guessed sets and their border, in one pass."""
    frequent = singles.filter(F.col("cnt") >= least).select("items")
    longest = guess.agg(F.max("k")).first()[0] or 1
    sets, width, k = [], 1, 2
    while k <= longest + 1 and (max_size is None or k <= max_size):
        # Level 2 starts from the items known to be frequent, later ones from the sample's sets.
        cand = candidates(frequent if k == 2 else guess.filter(F.col("k") == k - 1).select("items"), k)
        own = guess.filter(F.col("k") == k).select("items")
        sets.append(cand.unionByName(own).distinct())
        width, k = k, k + 1
    wanted, rows = _checkpoint_counted(reduce(DataFrame.unionByName, sets))
    if not rows:
        return wanted.select("items", F.size("items").alias("k"), F.lit(0).cast("long").alias("cnt"))
    known = wanted.join(counter(wanted, rows, width), "items", "left").select(
        "items", F.size("items").alias("k"), F.coalesce("cnt", F.lit(0)).cast("long").alias("cnt")).checkpoint()
    _drop_checkpoint(wanted)
    return known


# ---- arriving batches ---------------------------------------------------------------

def _read(spark: SparkSession, state: str, part: str, before: int) -> DataFrame | None:
    """A part of the state written by batches before ``before``, None if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/{part}")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    rows = spark.read.parquet(f"{state}/{part}")
    return rows.filter(F.col("batch") < before)


def _last(spark: SparkSession, state: str, before: int):
    """The totals row of the last finished batch before ``before``."""
    totals = _read(spark, state, "totals", before)
    return None if totals is None else totals.orderBy(F.desc("batch")).first()


def update_itemsets(state: str, batch: DataFrame, batch_id: int, min_support: float = DEFAULT_MIN_SUPPORT,
                    max_size: int | None = None, whole: bool = False, tid: str = "tid", item: str = "item") -> int:
    """Take a batch of transaction rows into the state folder; returns the levels recounted.

    Batches come with rising ids. A batch taken again (after a failure) replaces what it wrote and
    reads only earlier ones, so results are the same; its totals are written last and finish it. A
    transaction may arrive in pieces over batches: its old rows are looked up. ``whole`` says that
    none does, which saves reading the stored rows. Support and size are fixed by the first batch.
    """
    spark = batch.sparkSession
    ensure_checkpoint_dir(spark)
    last = _last(spark, state, batch_id)
    if last is not None and (last["min_support"], last["max_size"]) != (min_support, max_size):
        raise ValueError(f"the state was begun with support {last['min_support']} and size {last['max_size']}")
    n = last["n"] if last else 0
    stored = _read(spark, state, "pairs", batch_id) if last else None
    tracked = _read(spark, state, "tracked", batch_id).filter(F.col("batch") == last["batch"]).drop("batch") if last else None

    fresh, before = _pairs(batch, tid, item), None
    if stored is not None and not whole:
        tids = fresh.select("tid").distinct().checkpoint()
        before = stored.drop("batch").join(tids, "tid", "left_semi").checkpoint()
        fresh = fresh.join(before, ["tid", "item"], "left_anti")
    fresh.write.mode("overwrite").parquet(f"{state}/pairs/batch={batch_id}")
    fresh = spark.read.parquet(f"{state}/pairs/batch={batch_id}")
    # Only transactions with a new row change any count.
    changed = fresh.select("tid").distinct()
    if before is not None:
        before = before.join(changed, "tid", "left_semi").checkpoint()
        n += changed.join(before.select("tid").distinct(), "tid", "left_anti").count()
    else:
        n += changed.count()

    singles, known = _singles(fresh), spark.createDataFrame([], ITEMSET)
    if tracked is not None:
        singles = singles.unionByName(tracked.filter("k = 1")).groupBy("items", "k").agg(F.sum("cnt").alias("cnt"))
        known = _moved(tracked.filter("k > 1"), fresh, before)
    singles = singles.checkpoint()
    passes = 0
    if n:
        least = least_count(n, min_support)
        every = fresh if stored is None else stored.drop("batch").unionByName(fresh)
        counter = _Counter(_having(every, singles, least), n)
        try:
            now, passes = complete_levels(singles, known, least, max_size, counter)
        finally:
            counter.close()
    else:
        now = singles
    now.write.mode("overwrite").parquet(f"{state}/tracked/batch={batch_id}")
    spark.createDataFrame([(n, min_support, max_size, passes)], "n long, min_support double, max_size int, passes int").coalesce(1).write.mode(
        "overwrite").parquet(f"{state}/totals/batch={batch_id}")
    return passes


def _moved(sets: DataFrame, fresh: DataFrame, before: DataFrame | None) -> DataFrame:
    """``sets`` with the counts that the changed transactions add: those after less those before."""
    rows, width = sets.agg(F.count(F.lit(1)), F.max("k")).first()
    if not rows:
        return sets
    used = sets.select(F.explode("items").alias("item")).distinct().checkpoint()
    sides = [(1, fresh if before is None else fresh.unionByName(before))]
    if before is not None:
        sides.append((-1, before))
    deltas = []
    for sign, pairs in sides:
        mine, many = _checkpoint_counted(pairs.join(used, "item", "left_semi").select("tid", "item"))
        if many:
            counter = _Counter(mine, mine.select("tid").distinct().count())
            deltas.append(counter(sets.select("items"), rows, width).select("items", (F.col("cnt") * sign).alias("d")).checkpoint())
            counter.close()
    if not deltas:
        return sets
    delta = reduce(DataFrame.unionByName, deltas).groupBy("items").agg(F.sum("d").alias("d"))
    return sets.join(delta, "items", "left").select(
        "items", "k", (F.col("cnt") + F.coalesce("d", F.lit(0))).alias("cnt")).checkpoint()


def stored_itemsets(spark: SparkSession, state: str, batch_id: int | None = None) -> tuple[DataFrame, int]:
    """``(itemsets, n)`` after a batch (by default the last finished one)."""
    last = _last(spark, state, (1 << 62) if batch_id is None else batch_id + 1)
    if last is None or last["n"] == 0:
        return spark.createDataFrame([], ITEMSET), 0
    rows = spark.read.parquet(os.path.join(state, "tracked", f"batch={last['batch']}"))
    return rows.filter(F.col("cnt") >= least_count(last["n"], last["min_support"])), last["n"]

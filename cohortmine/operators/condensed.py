"""Condensed itemsets: closed and maximal ones, and all supports rebuilt from the closed (H4).

An itemset is closed if no superset has its count, maximal if no superset is frequent. Both need
only the supersets of one item more: counts fall along a chain of supersets, so a larger superset
of equal count has one of one item more of equal count on the way, frequent as well. That makes
either test an equi-join of the itemsets with the subsets that lack one item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmine.session import ensure_checkpoint_dir


def _one_shorter(itemsets: DataFrame) -> DataFrame:
    """(items, above): every itemset's subsets without one item, with the itemset's count."""
    left = F.transform("items", lambda _, i: F.filter("items", lambda _, j: j != i))
    return itemsets.filter(F.size("items") >= 2).select(F.explode(left).alias("items"), F.col("cnt").alias("above"))


def closed_itemsets(itemsets: DataFrame) -> DataFrame:
    """The rows of a complete mining result ``(items, .., cnt)`` that no superset matches in count.

    A result cut at a size counts its longest itemsets as closed.
    """
    same = _one_shorter(itemsets).withColumnRenamed("above", "cnt").distinct()
    return itemsets.join(same, ["items", "cnt"], "left_anti").select(*itemsets.columns)


def maximal_itemsets(itemsets: DataFrame) -> DataFrame:
    """The rows of a complete mining result that have no frequent superset."""
    return itemsets.join(_one_shorter(itemsets).select("items").distinct(), "items", "left_anti").select(*itemsets.columns)


def supports_from_closed(closed: DataFrame) -> DataFrame:
    """(items, k, cnt) of every subset of the closed itemsets: the whole result they condense.

    An itemset has the count of its least closed superset, the greatest count among all of them.
    Sizes go down one by one: an itemset hands its count to its subsets without one item and the
    greatest count met wins, so no itemset is split into all of its subsets at once.
    """
    ensure_checkpoint_dir(closed.sparkSession)
    longest = closed.agg(F.max(F.size("items"))).first()[0] or 0
    out, down = None, None
    for size in range(longest, 0, -1):
        mine = closed.filter(F.size("items") == size).select("items", "cnt")
        met = mine if down is None else mine.unionByName(down)
        level = met.groupBy("items").agg(F.max("cnt").alias("cnt")).checkpoint()
        out = level if out is None else out.unionByName(level)
        down = _one_shorter(level).select("items", F.col("above").alias("cnt"))
    if out is None:
        out = closed.select("items", "cnt")
    return out.select("items", F.size("items").alias("k"), "cnt")


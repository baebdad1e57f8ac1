"""Association rules and the support report (P7, J5, U1, A7, A8, F7, O5; H5, H6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmine.functions import half_up_milli, milli_to_double, subset_by_mask
from cohortmine.schemas import DEFAULT_MIN_CONFIDENCE
from cohortmine.session import ensure_checkpoint_dir


MASK_BITS = 16        # bits of a mask that one generator spans
MAX_SUBSET_SIZE = 62  # masks are BIGINTs


def expand_subsets(itemsets: DataFrame) -> DataFrame:
    """One row per non-empty proper subset of each itemset.

    Output ``(items, cnt, antecedent, consequent)``: mask m runs over 1 .. 2^size-2,
    bit i selects ``items[i]`` into the antecedent (original order); the other
    items form the consequent (U1, set difference). Size-1 itemsets have none.

    A mask is put together from parts of ``MASK_BITS`` bits, each from its own generator,
    so no row ever holds more than 2^16 of them. Sizes above ``MAX_SUBSET_SIZE`` cannot be
    enumerated and fail the query.
    """
    size = F.size("items")
    too_large = F.raise_error(F.concat(F.lit("itemset too large to enumerate its subsets: size "), size.cast("string")))
    ex = itemsets.filter(F.when(size <= MAX_SUBSET_SIZE, size >= 2).otherwise(too_large.cast("boolean"))).select(
        "items", "cnt", F.lit(0).cast("long").alias("mask"))
    one = F.lit(1).cast("long")
    for low in range(0, MAX_SUBSET_SIZE, MASK_BITS):
        bits = F.least(F.greatest(size - low, F.lit(0)), F.lit(MASK_BITS))
        part = F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("shiftleft", one, bits) - 1))
        ex = ex.select("items", "cnt", "mask", part.alias("part")).select(
            "items", "cnt", F.col("mask").bitwiseOR(F.shiftleft("part", low)).alias("mask"))
    ex = ex.filter((F.col("mask") != 0) & (F.col("mask") != F.call_function("shiftleft", one, size) - 1))
    return ex.select("items", "cnt",
                     subset_by_mask("items", "mask", 1).alias("antecedent"),
                     subset_by_mask("items", "mask", 0).alias("consequent"))


def rule_complement(itemsets: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """J5 + U1: subsets joined (inner) with the counted itemsets on the antecedent.

    Output ``(antecedent, consequent, items, cnt, ante_cnt)``. A subset missing from
    ``counted`` drops its rule, as in the reference (D13). The counted side is one row
    per key; whether it is broadcast is left to AQE, which knows its size at run time
    and splits skewed antecedent partitions otherwise.
    """
    counted = itemsets if counted is None else counted
    ante = counted.select(F.col("items").alias("antecedent"), F.col("cnt").alias("ante_cnt"))
    return expand_subsets(itemsets).join(ante, "antecedent").select(
        "antecedent", "consequent", "items", "cnt", "ante_cnt")


def confidence(cnt: Column | str, ante_cnt: Column | str) -> Column:
    """``round(cnt/ante_cnt, 3)`` HALF_UP as a DOUBLE."""
    return milli_to_double(half_up_milli(cnt, ante_cnt))


def association_rules(itemsets: DataFrame, counted: DataFrame | None = None,
                      min_confidence: float = DEFAULT_MIN_CONFIDENCE,
                      k: int | None = None, ordered: bool = False) -> DataFrame:
    """H6: rules ``(antecedent, consequent, confidence)`` with consequents of any size.

    ``itemsets`` are the sets to split (only size ``k`` when given); ``counted``
    supplies antecedent counts (default: ``itemsets`` itself). The filter applies to
    the rounded confidence, strictly (F7, D11). Confidences above 1 (inconsistent
    inputs) are kept (D6). ``ordered`` sorts by falling confidence, then items (O5).
    """
    src = itemsets if k is None else itemsets.filter(F.size("items") == k)
    rules = rule_complement(src, itemsets if counted is None else counted)
    out = (rules.select("antecedent", "consequent",
                        confidence("cnt", "ante_cnt").alias("confidence"))
           .filter(F.col("confidence") > F.lit(float(min_confidence))))
    return out.orderBy(F.desc("confidence"), "antecedent", "consequent") if ordered else out


def grown_rules(itemsets: DataFrame, counted: DataFrame | None = None,
                min_confidence: float = DEFAULT_MIN_CONFIDENCE, k: int | None = None,
                ordered: bool = False) -> DataFrame:
    """H6 by growing consequents: the rows of :func:`association_rules`, without its 2^k subsets.

    For one itemset the confidence of A -> C falls (or stays) as items move from A to C, since the
    count of A grows. So consequents grow level by level: two passing ones that differ in their
    last item make one of the next size, and what fails is never extended. Work follows the rules
    that pass, not the subsets there are; an itemset of any size can be split.

    ``counted`` must hold every subset of an itemset with its true count, as a miner's result does.
    Where subsets are missing or counts contradict each other (D6, D13), a failing consequent says
    nothing about larger ones: use :func:`association_rules` there.

    Each level is one keyed join within the itemsets and one with the antecedents' counts, cut by a
    reliable checkpoint; the driver sees one row count a level.
    """
    ensure_checkpoint_dir(itemsets.sparkSession)
    src = itemsets if k is None else itemsets.filter(F.size("items") == k)
    ante = (itemsets if counted is None else counted).select(
        F.col("items").alias("antecedent"), F.col("cnt").alias("ante_cnt"))

    def passing(grown: DataFrame) -> DataFrame:
        split = grown.withColumn("antecedent", F.array_except("items", "consequent"))
        rated = split.join(ante, "antecedent").withColumn("confidence", confidence("cnt", "ante_cnt"))
        return rated.filter(F.col("confidence") > F.lit(float(min_confidence))).select(
            "items", "cnt", "antecedent", "consequent", "confidence").checkpoint()

    first = src.filter(F.size("items") >= 2).select("items", "cnt", F.explode("items").alias("x"))
    level = passing(first.select("items", "cnt", F.array("x").alias("consequent")))
    out, size = level, 1
    while not level.isEmpty():
        prefix, last = F.slice("consequent", 1, size - 1), F.element_at("consequent", -1)
        one = level.filter(F.size("items") > size + 1).select("items", "cnt", prefix.alias("prefix"), last.alias("x"))
        two = one.select("items", "prefix", F.col("x").alias("y"))
        grown = one.join(two, ["items", "prefix"]).filter(
            F.array_position("items", F.col("x")) < F.array_position("items", F.col("y"))).select(
            "items", "cnt", F.concat("prefix", F.array("x", "y")).alias("consequent"))
        level = passing(grown)
        out, size = out.unionByName(level), size + 1
    rules = out.select("antecedent", "consequent", "confidence")
    return rules.orderBy(F.desc("confidence"), "antecedent", "consequent") if ordered else rules


def support_report(itemsets: DataFrame, n: int, k: int | None = None) -> DataFrame:
    """H5: ``(support, items)`` with support = round(cnt/n, 3) HALF_UP."""
    src = itemsets if k is None else itemsets.filter(F.size("items") == k)
    return src.select(milli_to_double(half_up_milli("cnt", F.lit(int(n)))).alias("support"),
                      "items")

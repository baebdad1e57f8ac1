"""Transactions and baskets (J2, A3, A4; H3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmine.operators.cohort import strong_measurements
from cohortmine.schemas import DEFAULT_MIN_VALUE


def cohort_measurements(measurements: DataFrame, cohort_df: DataFrame,
                        min_value: float = DEFAULT_MIN_VALUE,
                        feature: int | None = None) -> DataFrame:
    """Strong measurement rows of cohort subjects (left-semi join on subject_id).

    The cohort side is one row per subject; Spark broadcasts it only when its
    runtime size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE), otherwise
    a sort-merge semi join runs, with AQE splitting skewed subject partitions.
    """
    return strong_measurements(measurements, feature, min_value).join(
        cohort_df.select("subject_id"), "subject_id", "left_semi")


def transactions(measurements: DataFrame, cohort_df: DataFrame,
                 min_value: float = DEFAULT_MIN_VALUE, feature: int | None = None) -> DataFrame:
    """H3: distinct ``(tid, item)`` pairs: one per (cohort subject, strongly expressed
    feature). Duplicate measurement rows collapse in the map-side partial aggregate."""
    return (cohort_measurements(measurements, cohort_df, min_value, feature)
            .select(F.col("subject_id").alias("tid"), F.col("feature_id").cast("int").alias("item"))
            .distinct())


def baskets(tx: DataFrame) -> DataFrame:
    """A3: ``(tid, items)`` with the basket as a sorted ``ARRAY<INT>``.

    ``tx`` holds distinct pairs, so a basket is bounded by the item vocabulary.
    """
    return tx.groupBy("tid").agg(F.array_sort(F.collect_set("item")).alias("items"))


def transaction_count(tx: DataFrame) -> DataFrame:
    """A4: one row ``n`` = transactions with at least one strong measurement."""
    return tx.agg(F.count_distinct("tid").cast("long").alias("n"))

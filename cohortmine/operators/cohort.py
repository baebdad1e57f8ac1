"""Cohort selection and label profiling (P3, F1-F3, J1, A1, A2, O1; H1, H2)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmine.functions import java_trim
from cohortmine.schemas import DEFAULT_FEATURE, DEFAULT_LABELS, DEFAULT_MIN_VALUE


def explode_labels(subjects: DataFrame, labels: Iterable[str] | None = DEFAULT_LABELS,
                   subject_col: str = "subject_id", labels_col: str = "labels") -> DataFrame:
    """P3 + F1: one ``(subject_id, label)`` row per label token of each subject.

    The label field is trimmed and split on single spaces; each token is trimmed
    (Java semantics) and kept when it is in ``labels`` (any non-empty token when
    ``labels`` is None). A label listed twice for a subject yields two rows.
    """
    tokens = F.split(java_trim(F.col(labels_col)), " ")
    out = (subjects
           .select(F.col(subject_col).alias("subject_id"), F.explode(tokens).alias("token"))
           .select("subject_id", java_trim("token").alias("label")))
    if labels is None:
        return out.filter(F.col("label") != "")
    return out.filter(F.col("label").isin(list(labels)))


def cohort(subjects: DataFrame, labels: Iterable[str] | None = DEFAULT_LABELS, **kw) -> DataFrame:
    """H2: distinct subjects carrying at least one of ``labels``."""
    return explode_labels(subjects, labels, **kw).select("subject_id").distinct()


def subject_labels(subjects: DataFrame, labels: Iterable[str] | None = DEFAULT_LABELS,
                   **kw) -> DataFrame:
    """A2: ``(subject_id, labels)`` with the subject's matched labels, distinct, sorted,
    joined by ``;``.

    ``collect_set`` de-duplicates in the map-side partial aggregate, so one shuffle
    by subject suffices and a subject repeated in many rows still carries at most one
    entry per distinct label (bounded by the label list).
    """
    return explode_labels(subjects, labels, **kw).groupBy("subject_id").agg(
        F.concat_ws(";", F.array_sort(F.collect_set("label"))).alias("labels"))


def strong_measurements(measurements: DataFrame, feature: int | None = DEFAULT_FEATURE,
                        min_value: float = DEFAULT_MIN_VALUE) -> DataFrame:
    """F2 + F3 + P1: rows with ``value > min_value`` (strict, NaN excluded), optionally
    only one feature. Both predicates reach the Parquet scan as pushed filters."""
    cond = (F.col("value") > F.lit(float(min_value))) & ~F.isnan("value")
    if feature is not None:
        cond = (F.col("feature_id") == F.lit(feature)) & cond
    return measurements.filter(cond).select("subject_id", "feature_id", "value")


def label_counts(subjects: DataFrame, measurements: DataFrame,
                 labels: Iterable[str] | None = DEFAULT_LABELS,
                 feature: int | None = DEFAULT_FEATURE,
                 min_value: float = DEFAULT_MIN_VALUE) -> DataFrame:
    """H1: per label, the number of (subject-label, strong measurement) join rows.

    Equal to ``count(*)`` over ``labels JOIN measurements USING (subject_id)``, but the
    measurements are first reduced to one ``(subject_id, m)`` row per subject with a
    partial (map-side) aggregation, so a subject owning a large share of the rows
    never reaches the join as more than one row. The final aggregation and the join
    share the same ``subject_id`` partitioning (one shuffle of the reduced rows).
    """
    per_subject = (strong_measurements(measurements, feature, min_value)
                   .groupBy("subject_id").agg(F.count(F.lit(1)).alias("m")))
    return (explode_labels(subjects, labels)
            .join(per_subject, "subject_id")
            .groupBy("label").agg(F.sum("m").cast("long").alias("cnt"))
            .orderBy(F.desc("cnt"), "label"))

"""Measurements stored by subject, so that cohort joins and baskets move no measurement row.

:func:`store_measurements` writes the fact table once, bucketed and sorted by subject, into a shared
folder. A subject's rows then lie in one bucket, and everything keyed by subject - the cohort
join, distinct transactions, baskets, counts per subject - runs where the rows are: the plans
have no Exchange on the measurement side, at any size.

A bucket is read by one task, so a subject may not be too large for it. Subjects with more rows
than an even bucket holds (``rows / buckets``, so there are fewer of them than buckets and their
list may be broadcast) are *hot*: their rows go to a second, unbucketed table, read in splits and
pre-aggregated before the shuffle. The tables share no subject, so their results are put together.

Defined cases: null subjects are measurements of nobody and are not stored (no join by subject
finds them); repeated rows are kept; null features and values are kept; an empty table gives an
empty store; other columns are not stored; a folder is written once, a second write to it fails.
Subject ids keep their type.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmine.operators.baskets import baskets, transactions
from cohortmine.operators.cohort import explode_labels, strong_measurements
from cohortmine.schemas import DEFAULT_FEATURE, DEFAULT_LABELS, DEFAULT_MIN_VALUE

COLUMNS = ("subject_id", "feature_id", "value")
BUCKET_BYTES = 512 << 20   # a bucket's size, as rows of about ROW_BYTES
ROW_BYTES = 16


@dataclass(frozen=True)
class StoredMeasurements:
    """``even``: bucketed by subject. ``hot``: the rows of subjects too large for a bucket."""

    even: DataFrame
    hot: DataFrame
    buckets: int
    has_hot: bool

    def both(self, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``fn`` of the even and of the hot rows, put together. Only for results whose rows
        belong to one subject each."""
        return fn(self.even).unionByName(fn(self.hot)) if self.has_hot else fn(self.even)


def _table(spark: SparkSession, path: str) -> str:
    return "stored_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def _buckets_for(rows: int, least: int) -> int:
    return max(least, math.ceil(rows * ROW_BYTES / BUCKET_BYTES))


def store_measurements(measurements: DataFrame, path: str, buckets: int | None = None,
                       hot_rows: int | None = None) -> StoredMeasurements:
    """Write ``(subject_id, feature_id, value)`` bucketed by subject below ``path``, a shared folder.

    ``buckets``: by default about 512 MB of plain rows each, at least the session's shuffle
    partitions. ``hot_rows``: subjects with more rows than this are stored apart; by default, and
    at least, an even bucket's rows.
    """
    spark = measurements.sparkSession
    rows = measurements.select(*COLUMNS).filter(F.col("subject_id").isNotNull())
    per_subject = rows.groupBy("subject_id").agg(F.count(F.lit(1)).alias("n"))
    total = rows.count()
    buckets = buckets or _buckets_for(total, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bound = max(hot_rows or 0, math.ceil(total / buckets))
    heavy = per_subject.filter(F.col("n") > bound).select(F.col("subject_id").alias("heavy_id"))
    heavy = heavy.checkpoint()  # fewer rows than buckets: their counts sum to no more than the total
    has_hot = not heavy.isEmpty()
    even = rows.join(F.broadcast(heavy), F.col("subject_id") == F.col("heavy_id"), "left_anti") if has_hot else rows
    # One task a bucket writes its file: rows are dealt by the hash that buckets use.
    (even.repartition(buckets, "subject_id").write.mode("errorifexists").format("parquet")
     .bucketBy(buckets, "subject_id").sortBy("subject_id", "feature_id")
     .option("path", f"{path}/even").saveAsTable(_table(spark, path)))
    hot = rows.join(F.broadcast(heavy), F.col("subject_id") == F.col("heavy_id"), "left_semi") if has_hot else rows.limit(0)
    hot.write.mode("errorifexists").parquet(f"{path}/hot")
    spec = spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(has_hot).alias("has_hot"))
    spec.coalesce(1).write.mode("errorifexists").json(f"{path}/spec")
    return open_measurements(spark, path)


def open_measurements(spark: SparkSession, path: str) -> StoredMeasurements:
    """The store written to ``path``, also in a session that did not write it."""
    spec = spark.read.schema("buckets int, has_hot boolean").json(f"{path}/spec").first()
    table = _table(spark, path)
    hot = spark.read.parquet(f"{path}/hot")
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in hot.schema)
        where = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (path '{where}/even') "
                  f"CLUSTERED BY (subject_id) SORTED BY (subject_id, feature_id) INTO {spec['buckets']} BUCKETS")
    return StoredMeasurements(spark.table(table), hot, spec["buckets"], spec["has_hot"])


def _dealt(keyed: DataFrame, store: StoredMeasurements) -> DataFrame:
    """Rows keyed by subject, dealt as the buckets are: with fewer buckets than shuffle partitions
    the planner would rather shuffle both sides anew."""
    return keyed.repartition(store.buckets, "subject_id")


def stored_transactions(store: StoredMeasurements, cohort_df: DataFrame,
                        min_value: float = DEFAULT_MIN_VALUE, feature: int | None = None) -> DataFrame:
    """J2 + H3: distinct ``(tid, item)``. Even rows stay in their buckets, only the cohort may move."""
    dealt = _dealt(cohort_df.select("subject_id"), store)
    return store.both(lambda rows: transactions(rows, dealt, min_value, feature))


def stored_baskets(store: StoredMeasurements, cohort_df: DataFrame,
                   min_value: float = DEFAULT_MIN_VALUE, feature: int | None = None) -> DataFrame:
    """A3: ``(tid, items)``, each basket put together in its subject's bucket."""
    dealt = _dealt(cohort_df.select("subject_id"), store)
    return store.both(lambda rows: baskets(transactions(rows, dealt, min_value, feature)))


def stored_label_counts(store: StoredMeasurements, subjects: DataFrame,
                        labels: Iterable[str] | None = DEFAULT_LABELS, feature: int | None = DEFAULT_FEATURE,
                        min_value: float = DEFAULT_MIN_VALUE) -> DataFrame:
    """J1 + A1 + O1: join rows per label; rows are counted by subject and joined in their buckets, one count
    a label and task is shuffled."""
    exploded = _dealt(explode_labels(subjects, labels), store)

    def per_label(rows: DataFrame) -> DataFrame:
        per_subject = (strong_measurements(rows, feature, min_value)
                       .groupBy("subject_id").agg(F.count(F.lit(1)).alias("m")))
        return per_subject.join(exploded, "subject_id").select("label", "m")

    return (store.both(per_label).groupBy("label").agg(F.sum("m").cast("long").alias("cnt"))
            .orderBy(F.desc("cnt"), "label"))

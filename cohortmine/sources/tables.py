"""Parquet sources and the two stand-in mappings of the driver tables.

M1 (mining): subject = customer, labels = c_mktsegment;
    measurement = lineitem x orders x part as (o_custkey, brand number, l_extendedprice).
M2 (multi-label): subject = part, labels = p_name (words);
    measurement = lineitem as (l_partkey, l_linenumber, l_extendedprice).

Only the needed columns are selected, so the Parquet scans read just those
(``ReadSchema``), and later filters on ``value`` reach the lineitem scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, listed anew on every call so files added in between are read."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def m1_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(subject_id, labels): one customer per row, market segment as the label field."""
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("subject_id"), F.col("c_mktsegment").alias("labels"))


def m1_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(subject_id, feature_id, value) = (o_custkey, int(brand number), l_extendedprice)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.substring_index("p_brand", "#", -1).cast("int").alias("feature_id"))
    return (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(orders, li.l_orderkey == orders.o_orderkey)
        .select(F.col("o_custkey").alias("subject_id"), "feature_id",
                F.col("l_extendedprice").alias("value"))
    )


def m2_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(subject_id, labels): one part per row, its name words as labels."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("subject_id"), F.col("p_name").alias("labels"))


def m2_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(subject_id, feature_id, value) = (l_partkey, l_linenumber, l_extendedprice)."""
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("subject_id"), F.col("l_linenumber").alias("feature_id"),
        F.col("l_extendedprice").alias("value"))

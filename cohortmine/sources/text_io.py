"""Text readers and writers for the reference's interchange formats.

Parquet is the native format; these keep the line formats readable and writable:

* measurements: ``subject,feature,value`` lines, the header known by its first field;
* subjects: comma text of any width whose second-to-last field holds the labels;
* counted itemsets: ``(count,a;b;)`` or ``count, a;b;c``;
* baskets: items separated by one space;
* outputs: ``(label,count)``, ``(count,a;b;)``, ``support\\ti1\\ti2``, ``ante\\tcons\\tconf``.

Parsing (``parse_*``, lines in) and formatting (``*_lines``, lines out) are functions of
DataFrames with a ``value`` column; readers and writers only add the files. A line that
cannot be parsed fails the query; ``split_*`` functions return the rows and the bad lines
instead. Writers use mode ``errorifexists`` by default, as the reference's text sinks do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmine.functions import itemset_string, parse_itemset_string

MEASUREMENT_HEADER = "patientid"
SUBJECT_HEADER = "id"


def _paths(path: str | list[str]) -> str | list[str]:
    """A path, a glob, a list, or a comma-separated list of paths."""
    if isinstance(path, str) and "," in path:
        return [p for p in path.split(",") if p]
    return path


def _measurements(lines: DataFrame, header_id: str) -> DataFrame:
    """Lines other than the header with their fields and whether they parse."""
    parts = F.split(F.col("value"), ",")
    rows = lines.filter(F.get(parts, F.lit(0)) != header_id).select(
        F.col("value").alias("line"), F.get(parts, F.lit(0)).alias("subject_id"),
        F.get(parts, F.lit(1)).try_cast("int").alias("feature_id"),
        F.get(parts, F.lit(2)).try_cast("double").alias("value"))
    return rows.withColumn("ok", F.col("feature_id").isNotNull() & F.col("value").isNotNull())


def _subjects(lines: DataFrame, header_id: str) -> DataFrame:
    parts = F.split(F.col("value"), ",")
    return lines.filter(F.get(parts, F.lit(0)) != header_id).select(
        F.col("value").alias("line"), F.get(parts, F.lit(0)).alias("subject_id"),
        F.get(parts, F.size(parts) - 2).alias("labels"), F.get(parts, F.size(parts) - 1).alias("last"),
        (F.size(parts) >= 2).alias("ok"))


def _all_good(rows: DataFrame, what: str) -> DataFrame:
    """The rows, or an error that names the first bad line met. The check sits in a filter,
    so it holds whichever columns are read later."""
    bad = F.raise_error(F.concat(F.lit(f"bad {what} line: "), F.col("line"))).cast("boolean")
    return rows.filter(F.when(F.col("ok"), F.lit(True)).otherwise(bad)).drop("ok", "line")


def _good_and_bad(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.filter("ok").drop("ok", "line"), rows.filter(~F.col("ok")).select(F.col("line").alias("value"))


def parse_measurement_lines(lines: DataFrame, header_id: str = MEASUREMENT_HEADER) -> DataFrame:
    """S1 + P2: ``subject,feature,value[,...]`` lines -> (subject_id, feature_id, value).

    Lines whose first field equals ``header_id`` are headers, wherever they stand. A missing
    field or a bad number fails the query, as it does in the reference.
    """
    return _all_good(_measurements(lines, header_id), "measurement")


def split_measurement_lines(lines: DataFrame, header_id: str = MEASUREMENT_HEADER) -> tuple[DataFrame, DataFrame]:
    """The parsed rows, and the lines (``value``) that do not parse."""
    return _good_and_bad(_measurements(lines, header_id))


def parse_subject_lines(lines: DataFrame, header_id: str = SUBJECT_HEADER) -> DataFrame:
    """S2 + P2: ragged comma lines -> (subject_id, labels, last).

    The label field is the second-to-last column, the header line is the one whose first
    field equals ``header_id``. A line with one field fails the query.
    """
    return _all_good(_subjects(lines, header_id), "subject")


def split_subject_lines(lines: DataFrame, header_id: str = SUBJECT_HEADER) -> tuple[DataFrame, DataFrame]:
    """The parsed rows, and the lines (``value``) that do not parse."""
    return _good_and_bad(_subjects(lines, header_id))


def read_measurements_csv(spark: SparkSession, path: str | list[str],
                          header_id: str = MEASUREMENT_HEADER) -> DataFrame:
    """Measurement lines of one or many files, see :func:`parse_measurement_lines`."""
    return parse_measurement_lines(spark.read.text(_paths(path)), header_id)


def read_subjects_text(spark: SparkSession, path: str | list[str],
                       header_id: str = SUBJECT_HEADER) -> DataFrame:
    """Subject lines of one or many files, see :func:`parse_subject_lines`."""
    return parse_subject_lines(spark.read.text(_paths(path)), header_id)


def parse_itemset_lines(lines: DataFrame) -> DataFrame:
    """Counted-itemset lines -> (items ARRAY<INT>, k, cnt).

    Whitespace and parentheses are removed, then the line splits at commas: field 0 is the
    count, field 1 the ``;``-separated items, later fields are not read. Blank lines are
    skipped, a line without both fields or with a bad number fails the query.
    """
    clean = F.regexp_replace(F.col("value"), r"[\s()]+", "")
    rows = lines.select(clean.alias("line")).filter(F.col("line") != "")
    parts = F.split(F.col("line"), ",")
    rows = rows.select("line", F.get(parts, F.lit(0)).try_cast("long").alias("cnt"), F.get(parts, F.lit(1)).alias("text"))
    rows = rows.withColumn("ok", F.col("cnt").isNotNull() & F.col("text").isNotNull())
    items = parse_itemset_string("text")
    return _all_good(rows, "itemset").select(F.array_sort(items).alias("items"), F.size(items).alias("k"), "cnt")


def read_itemsets_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """S3: counted-itemset files, see :func:`parse_itemset_lines`."""
    return parse_itemset_lines(spark.read.text(_paths(paths)))


def parse_basket_lines(lines: DataFrame) -> DataFrame:
    """One basket per line, items separated by single spaces -> (items ARRAY<STRING>)."""
    tokens = F.filter(F.split(F.col("value"), " "), lambda x: x != "")
    return lines.select(F.array_distinct(tokens).alias("items"))


def read_baskets_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Basket files, see :func:`parse_basket_lines`."""
    return parse_basket_lines(spark.read.text(_paths(path)))


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Plain text lines -> (value STRING)."""
    return spark.read.text(_paths(path))


def _write_text(df: DataFrame, path: str, mode: str) -> None:
    df.write.mode(mode).text(path)


def label_count_lines(counts: DataFrame) -> DataFrame:
    """K1: ``(label,count)`` lines, highest count first."""
    return counts.orderBy(F.desc("cnt"), "label").select(F.format_string("(%s,%d)", "label", "cnt").alias("value"))


def _itemset_line(size1_trailing: bool) -> Column:
    text = itemset_string("items")
    if not size1_trailing:
        text = F.when(F.size("items") == 1, F.element_at("items", 1).cast("string")).otherwise(text)
    return F.format_string("(%d,%s)", "cnt", text).alias("value")


def itemset_lines(itemsets: DataFrame, size1_trailing: bool = True) -> DataFrame:
    """K2/K3: ``(count,a;b;)`` lines, highest count first (O4). ``size1_trailing=False`` writes
    single items as ``(count,item)``, the variant without the trailing ``;``."""
    return itemsets.orderBy(F.desc("cnt"), "items").select(_itemset_line(size1_trailing))


def report_lines(report: DataFrame) -> DataFrame:
    """K4 + P6: ``support<TAB>i1<TAB>i2...`` lines."""
    return report.select(F.concat_ws("\t", F.col("support").cast("string"),
                                     F.array_join(F.col("items").cast("array<string>"), "\t")).alias("value"))


def rule_lines(rules: DataFrame) -> DataFrame:
    """K5 + P6: ``antecedent<TAB>consequent<TAB>confidence`` lines, highest confidence first."""
    return rules.orderBy(F.desc("confidence"), "antecedent", "consequent").select(
        F.concat_ws("\t", itemset_string("antecedent"), itemset_string("consequent"),
                    F.col("confidence").cast("string")).alias("value"))


def write_label_counts_text(counts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K1 as files, see :func:`label_count_lines`."""
    _write_text(label_count_lines(counts), path, mode)


def write_itemsets_text(itemsets: DataFrame, path: str, mode: str = "errorifexists",
                        by_level: bool = False, size1_trailing: bool = True) -> None:
    """K2/K3 as files, see :func:`itemset_lines`.

    ``by_level`` writes one folder per itemset size (``k=1``, ``k=2``, ...) in one job. Rows are
    range-partitioned by size, count and items, so a large level spans several files, in the
    order of their part numbers.
    """
    if by_level:
        out = itemsets.select(F.size("items").alias("k"), "cnt", "items", _itemset_line(size1_trailing))
        order = [F.asc("k"), F.desc("cnt"), F.asc("items")]
        (out.repartitionByRange(*order).sortWithinPartitions(*order).select("k", "value")
         .write.mode(mode).partitionBy("k").text(path))
        return
    _write_text(itemset_lines(itemsets, size1_trailing), path, mode)


def write_support_report_text(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K4 as files, see :func:`report_lines`."""
    _write_text(report_lines(report), path, mode)


def write_rules_text(rules: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K5 as files, see :func:`rule_lines`."""
    _write_text(rule_lines(rules), path, mode)


def write_itemsets_parquet(itemsets: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Native itemset sink: Parquet partitioned by size ``k``."""
    itemsets.write.mode(mode).partitionBy("k").parquet(path)

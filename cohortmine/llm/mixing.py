"""Mixing sources to target weights (operator 6, native): Efraimidis-Spirakis sampling.

Each source gets a target of words. Whole epochs of a source come first; the rest of its
target is filled by weighted sampling without replacement: every document draws the
exponential key -ln(u) / quality, documents are ordered by key within their source, and a
prefix sum of sizes meets the rest. ``u`` is a hash of (seed, document id, text hash), so
reruns agree whatever the partitioning.

No task holds a source: the order is cut into buckets that the keys' own distribution
function makes even (quality takes ten values, so the mixture is known exactly from counts),
bucket sums give each bucket its offset, and only a bucket's rows are sorted together.

Defined cases: a null text has size 0; a null source is a source of its own, last in order;
documents of size 0 are taken 0 times; repeated rows each count and are interchangeable; an
empty table gives no rows; other columns that clash with a result column give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortmine.llm.common import WORD, checkpointed, own_columns, read, text_or_empty

WEIGHTS = (5.0, 2.0, 1.0)   # by the source's place, repeating
MAX_EPOCHS = 3              # a target stops at this many times its source's size
BUCKET_ROWS = 1_000       # expected rows sorted in one group
SEED = 17


def quality(text: Column) -> Column:
    """Sampling weight of a document in tenths, 0.1 to 1.0: the share of characters that are
    neither digits nor markup symbols (an empty text gets 0.1)."""
    odd = F.regexp_count(text, F.lit(r"([0-9#*$%&|<>])"))
    share = 1 - odd / F.greatest(F.length(text), F.lit(1))
    return F.when(F.length(text) == 0, F.lit(0.1)).otherwise(
        F.greatest(F.ceil(share * 10) / 10.0, F.lit(0.1))).cast("double")


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same with ``target``.

    Sources in code-point order, nulls last, take the weights in turn and share the sum of all
    sizes; a target above ``max_epochs`` times its source's size stops there and the excess is
    reshared by weight until none is above. The loop holds three numbers on the driver.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]),
              ((F.row_number().over(order) - 1) % len(weights)).cast("int"))
    cap = F.col("source_size") * float(max_epochs)
    s = checkpointed(sizes.withColumn("__w", w).withColumn("__cap", cap))
    total = s.agg(F.sum("source_size")).first()[0] or 0
    rate, capped = 0.0, -1
    while True:
        over = F.col("__cap") < F.lit(rate) * F.col("__w")
        n, held, free = s.agg(F.count(F.when(over, 1)), F.sum(F.when(over, F.col("__cap"))),
                              F.sum(F.when(~over, F.col("__w")))).first()
        if n == capped or not free:
            break
        capped, rate = n, (total - (held or 0.0)) / free
    return s.select("source", "source_size", F.least(F.col("__cap"), F.lit(rate) * F.col("__w")).alias("target"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, __t text hash, source, size, source_size, target, copies, taken), a row a document.

    ``copies`` is how many times the mix takes the document, ``taken`` the words that makes. The
    last document of the fractional part is taken if that brings the source nearer its target.
    """
    t = text_or_empty(text)
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(t))
    u = (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    drawn = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(t).alias("__t"),
        F.regexp_count(t, F.lit(f"({WORD})")).cast("long").alias("size"), quality(t).alias("__q"),
        u.alias("__u"))
    rows = checkpointed(drawn.withColumn("__key", -F.log("__u") / F.col("__q")).drop("__u"))

    per_q = rows.groupBy("source", "__q").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    per_source = per_q.groupBy("source").agg(
        F.sum("n").alias("__n"), F.sum("size").alias("source_size"),
        F.collect_list(F.struct("__q", "n")).alias("__law"))  # ten entries at most
    aims = targets(per_source.select("source", "source_size"), weights, max_epochs)
    per_source = per_source.select("source", "__n", "__law").alias("l").join(
        aims.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source"))).select(
        F.col("l.source").alias("__s"), "__n", "__law", "source_size", "target")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    per_source = checkpointed(per_source.withColumn("__epochs", epochs.cast("long")).withColumn(
        "__rest", F.col("target") - F.col("__epochs") * F.col("source_size")))

    below = F.aggregate("__law", F.lit(0.0), lambda a, x: a + x["n"] * (1 - F.exp(-x["__q"] * F.col("__key"))))
    buckets = F.ceil(F.col("__n") / float(bucket_rows))
    placed = rows.join(per_source, F.col("source").eqNullSafe(F.col("__s"))).withColumn(
        "__b", F.floor(below / F.col("__n") * buckets))
    sums = placed.groupBy("__s", "__b").agg(F.sum("size").alias("__sum"))
    before = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("__s").alias("__os"), F.col("__b").alias("__ob"),
                          F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__s", "__b").orderBy("__key", "doc_id", "__t").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = placed.withColumn("__cum", F.sum("size").over(inside)).join(
        offsets, F.col("__s").eqNullSafe(F.col("__os")) & (F.col("__b") == F.col("__ob")))
    middle = F.col("__offset") + F.col("__cum") - F.col("size") / 2.0
    copies = F.when(F.col("size") == 0, 0).otherwise(
        F.col("__epochs") + (middle <= F.col("__rest")).cast("long")).cast("long")
    return ranked.withColumn("copies", copies).select(
        "doc_id", "__t", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source",
                    doc_id: str = "doc_id", **how) -> DataFrame:
    """The mix itself: every row of ``docs`` as many times as it is taken, columns as they were.

    Rows with equal id and text may be taken differently; the total over them is handed out
    among them, which no reader can tell apart since the rows are equal in id, text and source.
    """
    plan = mix(docs, text, source, doc_id, **how).groupBy("doc_id", "__t", "source").agg(
        F.sum("copies").alias("__sum"), F.count("*").alias("__rows")).select(
        F.col("doc_id").alias("__i"), F.col("__t").alias("__pt"), F.col("source").alias("__ps"),
        "__sum", "__rows").filter(F.col("__sum") > 0)
    keyed = docs.withColumn("__t", F.xxhash64(text_or_empty(text)))
    joined = keyed.join(plan, keyed[doc_id].eqNullSafe(F.col("__i")) & (keyed["__t"] == F.col("__pt"))
                        & keyed[source].eqNullSafe(F.col("__ps")))
    # Equal rows share their total: each gets the whole part, one of them the remainder.
    each = joined.withColumn("__c", F.floor(F.col("__sum") / F.col("__rows")))
    rest = joined.filter(F.col("__sum") % F.col("__rows") > 0).filter(F.col("__rows") > 1)
    rest = rest.dropDuplicates(["__i", "__pt", "__ps"]).withColumn("__c", F.col("__sum") % F.col("__rows"))
    both = each.unionByName(rest).filter(F.col("__c") > 0)
    return both.withColumn("__x", F.explode(F.sequence(F.lit(1), F.col("__c")))).select(*own_columns(docs, ()))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")

"""Quality rules (operator 9, native): text counts plus cross-document line frequency.

The counts come from each whole text; the verdict then hashes normalised lines, counts the
distinct documents of a host that hold each line, removes lines above the limit from the
texts, and rejects documents that the removal depletes.

Defined cases: a null text counts as empty (no words, so it fails the base rule); null hosts
form one host; documents of the same host with equal texts count as one document in a line's
frequency, so plain copies never make each other's lines "frequent"; repeated rows get the
same result each; an empty table gives no rows; other columns are carried, never read, and
those that clash with a result column give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmine.llm.common import (
    SPACE,
    WORD,
    checkpointed,
    own_columns,
    read,
    restored,
    shielded,
    small_enough,
    text_or_empty,
    words_of,
)

MIN_WORDS = 50            # base: fewer words fail
MAX_REPEAT_PERCENT = 50   # base: more words than this in repeated 3-word windows fail
LINE_SHARE = 0.10         # a line in more than this share of a host's distinct documents goes
LINE_MIN_DOCS = 20        # and only if at least this many distinct documents hold it
DEPLETED_SHARE = 0.30     # a document left with less than this share of its words is rejected

BROADCAST_DOCS = 100_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MADE = (*COUNTS, "base_failed", "kept")


def _lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))


def normalised_line(line: Column) -> Column:
    """Lower case, runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(line), rf"[{SPACE}]+", " "))


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the five counts and ``base_failed`` to every row of ``docs``.

    ``n_repeat_words`` finds repeated windows by 64-bit hash within one text. Only texts that
    have a repeated window sort their (hash, position) pairs; the others stop at the distinct.
    """
    own = own_columns(docs, (*COUNTS, "base_failed"))
    t = text_or_empty(text)
    one = docs.select(*own, words_of(t).alias("__w"), _lines(t).alias("__l"),
                      F.regexp_count(t, F.lit(r"([#*$%&|<>])")).cast("long").alias("n_symbols"))
    n = F.size("__w")
    two = one.select(
        *own, "n_symbols", n.cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, F.transform(
            F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
            lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2))))
        .otherwise(F.array().cast("array<bigint>")).alias("__h"))
    # The row number keeps the optimizer from moving a later filter below the projections made
    # so far, where it would evaluate the words anew for every use of them.
    three = two.withColumn(
        "__s", F.when(F.size(F.array_distinct("__h")) < F.size("__h"),
                      F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))
    three = three.withColumn("__row", F.monotonically_increasing_id())
    s = F.col("__s")
    where = F.filter(F.transform(s, lambda e, i: F.when(
        F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False))
        | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False)), e["p"])), lambda p: p.isNotNull())
    covered = F.array_distinct(F.flatten(F.transform(where, lambda p: F.array(p, p + 1, p + 2))))
    four = three.withColumn("n_repeat_words", F.when(s.isNull() | (F.col("__row") < 0), F.lit(0)).otherwise(
        F.size(covered)).cast("long"))
    return four.select(
        *own, *COUNTS,
        ((F.col("n_words") < MIN_WORDS)
         | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"))


def _doc_lines(docs: DataFrame, keys: list[Column], text: str) -> DataFrame:
    """One row per line with a word: the keys, its place, the line's hash and its number of words."""
    t = text_or_empty(text)
    return docs.select(*keys, F.posexplode(F.split(t, "\n", -1)).alias("__p", "__l")).filter(
        F.col("__l").rlike(f"[^{SPACE}]")).select(
        *[F.col(k) for k in ("__host", "__id", "__t", "__p")],
        F.xxhash64(normalised_line(F.col("__l"))).alias("__h"),
        F.regexp_count("__l", F.lit(f"({WORD})")).alias("__n"))


def removals(docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id",
             line_share: float = LINE_SHARE, line_min_docs: int = LINE_MIN_DOCS,
             depleted_share: float = DEPLETED_SHARE) -> DataFrame:
    """(__host, __id, __t, __lines, __depleted): the documents with frequent lines and the lines' places.

    Line counts aggregate by (host, line, text hash) before they aggregate by (host, line),
    each with map-side partial sums, so a line that a third of all rows hold is no hot task.
    """
    keys = [F.col(host).alias("__host"), F.col(doc_id).alias("__id"),
            F.xxhash64(text_or_empty(text)).alias("__t")]
    lines = _doc_lines(docs, keys, text)
    held = (lines.groupBy("__host", "__h", "__t").agg(F.lit(1).alias("__one"))
            .groupBy("__host", "__h").agg(F.count("*").alias("__docs"))
            .filter(F.col("__docs") >= line_min_docs))
    sizes = (docs.select(*keys).groupBy("__host", "__t").agg(F.lit(1).alias("__one"))
             .groupBy("__host").agg(F.count("*").alias("__all")))
    sizes = sizes.withColumnRenamed("__host", "__h2")
    frequent = (held.join(sizes, F.col("__host").eqNullSafe(F.col("__h2")))
                .filter(F.col("__docs") > line_share * F.col("__all"))
                .select(F.col("__host").alias("__fh"), F.col("__h").alias("__fl")))
    hit = (F.col("__host").eqNullSafe(F.col("__fh"))) & (F.col("__h") == F.col("__fl"))
    # Repeated rows carry equal keys; each adds its lines to both sums, so the share stands.
    flagged = lines.join(frequent, hit, "left")
    return (flagged.groupBy("__host", "__id", "__t")
            .agg(F.sum("__n").alias("__all"),
                 F.sum(F.when(F.col("__fl").isNull(), F.col("__n")).otherwise(0)).alias("__left"),
                 F.collect_set(F.when(F.col("__fl").isNotNull(), F.col("__p"))).alias("__lines"))
            .filter(F.col("__left") < F.col("__all"))
            .select("__host", "__id", "__t", "__lines",
                    (F.col("__left") < depleted_share * F.col("__all")).alias("__depleted")))


def _less_lines(docs: DataFrame, text: str, n_chars: str) -> DataFrame:
    """``docs`` with its text less the lines at the places ``__lines``, ``n_chars`` (if there) set anew."""
    places = F.sequence(F.lit(0), F.size("__split") - 1)
    shorter = F.array_join(F.transform(F.array_except(places, F.col("__lines")), lambda i: F.get("__split", i)), "\n")
    out = docs.withColumn("__split", F.when(F.col("__lines").isNotNull(), F.split(text_or_empty(text), "\n", -1)))
    out = out.withColumn(text, F.when(F.col("__lines").isNotNull(), shorter).otherwise(F.col(text)))
    if n_chars in docs.columns:
        out = out.withColumn(n_chars, F.when(F.col("__lines").isNotNull(), F.length(text)).otherwise(F.col(n_chars)))
    return out


def _with_removals(docs: DataFrame, gone: DataFrame, host: str, doc_id: str) -> DataFrame:
    """``docs`` (with ``__t``) and the ``__lines`` and ``__depleted`` of each row, null without frequent lines."""
    side = gone.select(F.col("__host").alias("__gh"), F.col("__id").alias("__gi"), F.col("__t").alias("__gt"), "__lines", "__depleted")
    cond = (docs["__t"] == F.col("__gt")) & docs[host].eqNullSafe(F.col("__gh")) \
        & docs[doc_id].eqNullSafe(F.col("__gi"))
    return docs.join(side, cond, "left")


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id",
                  n_chars: str = "n_chars", **limits) -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``kept`` (neither base-failed nor depleted).

    The counts are of the whole text; the text returned is the one less its frequent lines.
    """
    own = own_columns(docs, MADE)
    gone = removals(docs, text, host, doc_id, **limits)
    counted = text_counts(docs.select(*own, F.xxhash64(text_or_empty(text)).alias("__t")), text)
    joined = _with_removals(counted, gone, host, doc_id).withColumn(
        "kept", ~F.col("base_failed") & ~F.coalesce("__depleted", F.lit(False)))
    return _less_lines(joined, text, n_chars).select(*own, *COUNTS, "base_failed", "kept")


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id",
              n_chars: str = "n_chars", **limits) -> DataFrame:
    """The rows of ``docs`` that the rules keep, less their frequent lines; other columns as they were.

    The removals are broadcast when they were counted to be few, so texts stay where they are.
    """
    columns = docs.columns
    docs, hidden = shielded(docs, MADE)
    gone = checkpointed(removals(docs, text, host, doc_id, **limits))
    if small_enough(gone, BROADCAST_DOCS):
        gone = F.broadcast(gone)
    marked = text_counts(docs, text).filter(~F.col("base_failed")).withColumn(
        "__t", F.xxhash64(text_or_empty(text)))
    left = _with_removals(marked, gone, host, doc_id).filter(~F.coalesce("__depleted", F.lit(False)))
    return restored(_less_lines(left, text, n_chars), columns, hidden)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return quality_rules(docs).select("doc_id", *COUNTS, "base_failed", "kept")

"""A stored Katz backoff model of any order: tables of n-grams and backoff weights (operator 8).

:func:`train` counts n-grams up to ``order`` and writes the model to a shared folder::

    ngrams/n=K/part=P     ctx, word, r, lp     count and log10 of the discounted probability
    backoff/n=K/part=P    ctx, la              log10 of the exactly normalised backoff weight
    spec                  order, training tokens, vocabulary, unknown mass, end count

and :func:`score` evaluates texts, also others than the training texts and in another session,
by recursion over the orders: an n-gram that is not in its table takes its context's backoff weight and
is looked up one order lower,

    p_n(w | h) = d(r) r / c(h)  if (h, w) was seen,  else  alpha(h) p_{n-1}(w | h without its first word),

down to single words and the unknown word. Discounts are those of :mod:`cohortmine.llm.katz`, with
counts of counts by order; at order 2 the scores are equal to its ``lm_scores``, which evaluates the
training texts while it counts and keeps no table.

Words and contexts are named by XXH64; a text starts with one start word, so its first words
have shorter contexts. Texts are read once by :func:`train` (n-grams of the highest order, summed
to the lower ones) and once by :func:`score`, whose look-ups are joins on whole distinct
n-grams: a frequent context is spread over its following words, and only n-grams not
found go on. Tables are parted by the hash of the context, that of very frequent
contexts and of single words by the word too. Nothing but the spectra of counts (six numbers an order) reaches
the driver, nothing is broadcast by hint.

Defined cases: those of :mod:`cohortmine.llm.katz` (null text, null id, repeated rows, no
training tokens, empty table, other columns); a folder is written once; an order below 1 is an error.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmine.llm.common import text_or_empty, words_of, written
from cohortmine.llm.katz import END, FOLDS, GT_MAX, HELD_OUT, LARGE_DISCOUNT, START, discounts

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_START, _END = int(START.view(np.int64)), int(END.view(np.int64))


@dataclass(frozen=True)
class Spec:
    order: int
    total: int
    words: int
    ends: int
    unknown: float
    parts: int


@dataclass(frozen=True)
class Model:
    path: str
    spec: Spec

    def ngrams(self, spark: SparkSession, n: int) -> DataFrame:
        return spark.read.schema("ctx long, word long, r long, lp double").parquet(f"{self.path}/ngrams/n={n}")

    def backoff(self, spark: SparkSession, n: int) -> DataFrame:
        return spark.read.schema("ctx long, la double").parquet(f"{self.path}/backoff/n={n}")


def _name(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def _train(doc_id: str) -> Column:
    return F.crc32(_name(doc_id).cast("binary")) % FOLDS != HELD_OUT


def _contexts(order: int) -> list[str]:
    return [f"ctx{k}" for k in range(2, order + 1)]


def _grams(rows: DataFrame, order: int, *keep: str) -> DataFrame:
    """One row a token: ``word`` and its contexts ``ctx2`` .. ``ctx<order>`` (null where the text
    is too short), from rows with a column ``text``."""
    tokens = F.concat(F.array(F.lit(_START)),
                      F.transform(words_of(F.translate("text", _UPPER, _LOWER)), lambda w: F.xxhash64(w)),
                      F.array(F.lit(_END)))
    before = [f"c{k}" for k in range(1, max(order, 2))]
    rows = rows.select(*keep, tokens.alias("w"))
    rows = rows.select(*keep, "w", *[
        F.concat(F.array_repeat(F.lit(None).cast("long"), k), F.col("w")).alias(f"c{k}") for k in range(1, len(before) + 1)])
    rows = rows.select(*keep, F.explode(F.arrays_zip("w", *before)).alias("g"))
    rows = rows.filter("g.w is not null and g.c1 is not null")  # the start word is no token
    return rows.select(*keep, F.col("g.w").alias("word"), *[
        F.when(F.col(f"g.c{k - 1}").isNotNull(), F.xxhash64(*[f"g.c{j}" for j in range(1, k)])).alias(f"ctx{k}")
        for k in range(2, order + 1)])


def _kept(r: Column, d: list[float]) -> Column:
    """What a count keeps after its discount."""
    factor = F.element_at(F.array(*[F.lit(x) for x in d]), F.least(r, F.lit(GT_MAX)).cast("int"))
    return F.when(r <= GT_MAX, r * factor).otherwise(r - LARGE_DISCOUNT)


def _store(df: DataFrame, path: str, parts: int, by: Column) -> None:
    (df.withColumn("part", F.pmod(by, F.lit(parts))).repartition(parts, "part")
     .write.mode("errorifexists").partitionBy("part").parquet(path))


def train(docs: DataFrame, path: str, order: int = 2, text: str = "text", doc_id: str = "doc_id",
          parts: int | None = None) -> Model:
    """Learn from the rows outside the held-out fold and write the model to ``path``."""
    if order < 1:
        raise ValueError("order must be at least 1")
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.filter(_train(doc_id)).select(text_or_empty(text).alias("text"))
    tops = written(_grams(rows, order).groupBy("word", *_contexts(order)).agg(F.count("*").alias("r")))
    model = None
    for n in range(1, order + 1):
        if n == 1:
            counts = tops.groupBy("word").agg(F.sum("r").alias("r")).select(F.lit(0).cast("long").alias("ctx"), "word", "r")
        else:  # a context has one shorter context
            shorter = F.first(f"ctx{n - 1}") if n > 2 else F.lit(0).cast("long")
            counts = tops.filter(F.col(f"ctx{n}").isNotNull()).groupBy(F.col(f"ctx{n}").alias("ctx"), "word").agg(
                F.sum("r").alias("r"), shorter.alias("short"))
        counts = written(counts)
        spectrum = counts.agg(F.coalesce(F.sum("r"), F.lit(0)), F.count("*"), F.coalesce(
            F.sum(F.when(F.col("word") == _END, F.col("r"))), F.lit(0)),
            *[F.count(F.when(F.col("r") == r, 1)) for r in range(1, GT_MAX + 2)]).first()
        d = discounts(list(spectrum[3:]))
        kept = _kept(F.col("r"), d)
        if n == 1:
            total, words, ends = spectrum[:3]
            lost = sum(spectrum[2 + r] * r * (1 - d[r - 1]) for r in range(1, GT_MAX + 1))
            lost += LARGE_DISCOUNT * (words - sum(spectrum[3:3 + GT_MAX]))
            model = Model(path, Spec(order, total, words, ends, lost / total if total else 1.0, parts))
            _store(counts.select("ctx", "word", "r", F.log10(kept / float(max(total, 1))).alias("lp")),
                   f"{path}/ngrams/n=1", parts, F.xxhash64("word"))
            continue
        lower = model.ngrams(spark, n - 1).select(
            F.col("ctx").alias("l_ctx"), F.col("word").alias("l_word"), F.pow(F.lit(10.0), "lp").alias("l_p"))
        # What was seen at this order was seen one order lower too.
        seen = counts.join(lower, (F.col("short") == F.col("l_ctx")) & (F.col("word") == F.col("l_word")))
        contexts = written(seen.groupBy("ctx").agg(
            F.sum("r").alias("c"), F.sum(F.col("r") - kept).alias("lost"), F.sum("l_p").alias("seen")))
        _store(contexts.select("ctx", F.log10(F.col("lost") / F.col("c") / (1 - F.col("seen"))).alias("la")),
               f"{path}/backoff/n={n}", parts, F.xxhash64("ctx"))
        chances = counts.join(contexts.select(F.col("ctx").alias("t_ctx"), "c"), F.col("ctx") == F.col("t_ctx"))
        frequent = F.col("c") > total / (4 * parts)
        spread = F.when(frequent, F.xxhash64("ctx", "word")).otherwise(F.xxhash64("ctx"))
        _store(chances.select("ctx", "word", "r", F.log10(kept / F.col("c")).alias("lp"), spread.alias("spread")).select(
            "ctx", "word", "r", "lp", "spread"), f"{path}/ngrams/n={n}", parts, F.col("spread"))
    spark.range(1).select(F.lit(json.dumps(asdict(model.spec))).alias("value")).coalesce(1).write.text(f"{path}/spec")
    return model


def load(spark: SparkSession, path: str) -> Model:
    """The model that :func:`train` wrote to ``path``."""
    return Model(path, Spec(**json.loads(spark.read.text(f"{path}/spec").first()[0])))


def _evaluated(spark: SparkSession, grams: DataFrame, model: Model) -> DataFrame:
    """Distinct n-grams (``word`` and contexts) with ``lp``, their log10 probability, and ``c``, the word's count."""
    spec, done = model.spec, None
    at = grams.withColumn("held", F.lit(0.0))
    for n in range(spec.order, 0, -1):
        names = [*_contexts(spec.order), "word"]
        table = model.ngrams(spark, n).select(
            F.col("ctx").alias("t_ctx"), F.col("word").alias("t_word"), F.col("lp").alias("t_lp"))
        on = F.col("word") == F.col("t_word")
        if n > 1:
            on = (F.col(f"ctx{n}") == F.col("t_ctx")) & on
        met = at.join(table, on, "left")
        if n == 1:
            hit = met.select(*names, (F.col("held") + F.coalesce("t_lp", F.lit(math.log10(spec.unknown)))).alias("lp"))
        else:
            met = written(met.select(*names, "held", "t_lp"))
            hit = met.filter("t_lp is not null").select(*names, (F.col("held") + F.col("t_lp")).alias("lp"))
            weight = model.backoff(spark, n).select(F.col("ctx").alias("b_ctx"), "la")
            at = (met.filter("t_lp is null").join(weight, F.col(f"ctx{n}") == F.col("b_ctx"), "left")
                  .select(*names, (F.col("held") + F.coalesce("la", F.lit(0.0))).alias("held")))
        done = hit if done is None else done.unionByName(hit)
    single = model.ngrams(spark, 1).select(F.col("word").alias("u_word"), F.col("r").alias("u_r"))
    return done.join(single, F.col("word") == F.col("u_word"), "left").select(
        *names, "lp", F.coalesce("u_r", F.lit(0)).alias("c"))


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row a document."""
    spark, spec = docs.sparkSession, model.spec
    key = F.xxhash64(_name(doc_id), text_or_empty(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), key.alias("key"), _train(doc_id).alias("train"),
                       text_or_empty(text).alias("text"))
    names = [*_contexts(spec.order), "word"]
    uses = written(_grams(rows, spec.order, "key").groupBy("key", *names).agg(F.count("*").alias("m")))
    known = _evaluated(spark, uses.select(*names).distinct(), model).withColumnsRenamed({n: f"k_{n}" for n in names})
    same = F.col("word") == F.col("k_word")
    for c in _contexts(spec.order):
        same = same & F.col(c).eqNullSafe(F.col(f"k_{c}"))
    m = F.col("m")
    sums = uses.join(known, same).groupBy("key").agg(
        F.sum(m * F.col("lp")).alias("score"), F.sum(m * F.log10(F.col("c") + 1.0)).alias("base"),
        F.sum("m").alias("tokens"), F.sum(F.when(F.col("c") > 0, m).otherwise(0)).alias("known"))
    flat = rows.select("doc_id", "key", "train")
    again = flat.groupBy("key").agg(F.count("*").alias("rows"))  # rows alike share their sums
    per = sums.join(again, "key").select(
        F.col("key").alias("k"), *[(F.col(x) / F.col("rows")).alias(x) for x in ("score", "base")],
        *[(F.col(x) / F.col("rows")).cast("long").alias(x) for x in ("tokens", "known")])
    return flat.join(per, F.col("key") == F.col("k")).select(
        "doc_id", (~F.col("train")).alias("held_out"), F.col("tokens").alias("n_tokens"), F.col("known").alias("n_known"),
        F.lit(spec.total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("tokens") * math.log10(spec.total + spec.words + 1)).alias("base_score"), "score")

"""Secret scans (operator 4, native): strong patterns plus multipart credential linking.

Base spans are assignments, access identifiers and long hex runs. Weak parts - identifiers,
secrets and endpoints that alone mean little - are joined by interval within a scope (a window
of code points of one document) and reported only where the parts that complete them occur:
an identifier needs a secret, a secret needs an identifier, an endpoint needs both.

The interval join never pairs parts: parts are pre-aggregated to the least and greatest start
per (document, bin of scope width, part), and a candidate looks up its own bin and the two
beside it, which decides exactly whether one lies within the scope.

Defined cases: a null text counts as empty; documents without spans get zeros and the hash of
the empty string; repeated rows (equal id and text) get equal results; an empty table gives no
rows; other columns are never read, and those that clash with a result column give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from cohortmine.llm.common import own_columns, read, text_or_empty

SCOPE = 200  # code points between the starts of linked parts

# The kinds in the order that breaks ties, and their patterns (Java syntax).
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # maximal runs, so the same matches as [0-9a-f]+ of 32 and more
WEAK_ID = r"""(?i:access_?key_?id|client_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@+/_.-]{3,}"""
WEAK_SECRET = r"""(?i:passphrase|pwd|pass|credential|private_?key|auth)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=!@#$%^&*-]{4,}"""
ENDPOINT = r"""(?i:https?|ftps?|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D"'<>]+"""


def _matches(text: Column, kind: str, pattern: str, value_group: int | None = None) -> Column:
    """Array of (kind, index, gap before, length, value length) of the leftmost matches.

    Positions come from the lengths of the gaps between matches; texts without a match (nearly
    all) stop after the one search.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    value = (F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
             if value_group is not None else found)
    row = F.arrays_zip(found.alias("m"), F.slice(gaps, 1, F.size(found)).alias("g"), value.alias("v"))
    return F.when(F.size(found) > 0, F.transform(row, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"),
        F.length(x["m"]).alias("len"), F.length(x["v"]).alias("value_len"))))


def parts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(__id, __t, kind, start, end, value_len) of every match of every pattern.

    ``__t`` is the text's hash; equal rows give equal matches and are counted once.
    """
    t = text_or_empty(text)
    hits = docs.select(F.col(doc_id).alias("__id"), F.xxhash64(t).alias("__t"), F.explode(F.concat(*[
        F.coalesce(_matches(t, *m), F.array().cast(
            "array<struct<kind:string,i:int,gap:int,len:int,value_len:int>>"))
        for m in (("assign", ASSIGN, 2), ("access", ACCESS), ("hex", HEX), ("weak_id", WEAK_ID),
                  ("weak_secret", WEAK_SECRET), ("endpoint", ENDPOINT))])).alias("x"))
    hits = hits.select("__id", "__t", "x.*").distinct()
    upto = Window.partitionBy("__id", "__t", "kind").orderBy("i").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("len")).over(upto)
    return hits.select("__id", "__t", "kind", "value_len", end.alias("end"),
                       (end - F.col("len")).alias("start"))


def spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", scope: int = SCOPE) -> DataFrame:
    """(__id, __t, kind, start, end) of all reported spans: base ones and linked weak ones."""
    strong = (((F.col("kind") == "assign") & (F.col("value_len") >= 8))
              | ((F.col("kind") == "access") & (F.col("value_len") >= 16)) | (F.col("kind") == "hex"))
    # Base patterns that fall short are weak parts of the same sort.
    kind = (F.when(strong, F.col("kind")).when(F.col("kind") == "assign", "weak_secret")
            .when(F.col("kind") == "access", "weak_id").otherwise(F.col("kind")))
    part = (F.when(F.col("kind").isin("access", "weak_id"), "id")
            .when(F.col("kind") == "endpoint", "endpoint").otherwise("secret"))
    found = parts(docs, text, doc_id).select(
        "__id", "__t", kind.alias("kind"), part.alias("part"), "start", "end",
        F.floor(F.col("start") / scope).alias("bin"))

    def of(p: str) -> Column:
        return F.when(F.col("part") == p, F.col("start"))

    bins = found.filter(F.col("part") != "endpoint").groupBy("__id", "__t", "bin").agg(
        F.min(of("id")).alias("id_lo"), F.max(of("id")).alias("id_hi"),
        F.min(of("secret")).alias("se_lo"), F.max(of("secret")).alias("se_hi")).select(
        F.col("__id").alias("b_id"), F.col("__t").alias("b_t"), F.col("bin").alias("b_bin"),
        "id_lo", "id_hi", "se_lo", "se_hi")
    weak = found.filter(F.col("kind").isin("weak_id", "weak_secret", "endpoint"))
    looked = weak.withColumn("side", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).join(
        bins, F.col("__id").eqNullSafe(F.col("b_id")) & (F.col("__t") == F.col("b_t"))
        & (F.col("bin") + F.col("side") == F.col("b_bin")))

    def near(lo: str, hi: str) -> Column:
        return F.coalesce(F.when(F.col("side") == 0, F.col(lo).isNotNull())
                          .when(F.col("side") < 0, F.col(hi) >= F.col("start") - scope)
                          .otherwise(F.col(lo) <= F.col("start") + scope), F.lit(False))

    linked = looked.groupBy("__id", "__t", "kind", "part", "start", "end").agg(
        F.max(near("id_lo", "id_hi")).alias("has_id"), F.max(near("se_lo", "se_hi")).alias("has_secret"))
    linked = linked.filter(F.when(F.col("part") == "id", F.col("has_secret"))
                           .when(F.col("part") == "secret", F.col("has_id"))
                           .otherwise(F.col("has_id") & F.col("has_secret")))
    out = ["__id", "__t", "kind", "start", "end"]
    return found.filter(F.col("kind").isin("assign", "access", "hex")).select(*out).unionByName(
        linked.select(*out))


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", scope: int = SCOPE) -> DataFrame:
    """``docs`` without its text, with n_assign, n_access, n_hex, base_sha256 and spans."""
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    listed = spans(docs, text, doc_id, scope).groupBy("__id", "__t").agg(
        F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("__all"))

    def joined(of: Column) -> Column:
        return F.array_join(F.transform(of, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("__all", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    digest = listed.select(
        F.col("__id").alias("__d_id"), F.col("__t").alias("__d_t"),
        *[count(k) for k in ("assign", "access", "hex")],
        F.sha2(joined(F.filter("__all", lambda x: x["rank"] <= 3)), 256).alias("base_sha256"),
        joined(F.col("__all")).alias("spans"))
    results = ("n_assign", "n_access", "n_hex", "base_sha256", "spans")
    own = own_columns(docs, (*results, text))
    slim = docs.select(*own, F.xxhash64(text_or_empty(text)).alias("__t"))
    return slim.join(digest, slim[doc_id].eqNullSafe(F.col("__d_id")) & (slim["__t"] == F.col("__d_t")), "left").select(
        *own, *[F.coalesce(F.col(f"n_{k}"), F.lit(0).cast("long")).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.coalesce(F.col("base_sha256"), F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce(F.col("spans"), F.lit("")).alias("spans"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents").select("doc_id", "text"))

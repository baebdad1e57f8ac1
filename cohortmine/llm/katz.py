"""LM scoring (operator 8): a Katz backoff model of words, trained and evaluated in Spark.

The model is of order 2 over words and an end token. Counts r up to ``GT_MAX`` are discounted
by Good-Turing (Katz's formula; where counts of counts are too thin for it, by half a count),
larger ones by ``LARGE_DISCOUNT`` of one count, so every context keeps some mass; backoff
weights are normalised exactly over the vocabulary and one unknown word:

    p(w | h) = d(r) r / c(h)   if the pair was seen, else   alpha(h) p(w);   p(w) alone if h is unknown
    p(w)     = d(c) c / N      if w was seen, the mass left otherwise
    alpha(h) = (1 - sum of seen p(w | h)) / (1 - sum of seen p(w))

Words are named by XXH64. Pass one counts words. Pass two deals the pairs of each batch of
texts, with the documents that hold them, by the hash of their first word (a frequent first
word - the list is bounded by the number of parts - is spread by its second word too). Each
part then holds all occurrences of its pairs: it counts them, scores what needs only the part,
and hands on per-document sums, context sums and unseen pairs, which joins finish.

The unigram table is broadcast to the parts only when it was counted to hold at most
``broadcast_words`` words; beyond that the parts hand on their pairs and joins look them up.

Defined cases: a null text is empty and scores its end token; a null doc_id is the empty id;
rows that repeat id and text each train and each get the same score; with no training tokens
every token is unknown with probability 1; an empty table gives no rows; other columns are not
read, clashing names give way to the result's.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmine.llm.common import read, text_or_empty, written

FOLDS, HELD_OUT = 7, 2
GT_MAX = 5
LARGE_DISCOUNT = 0.01
BATCH_TOKENS = 150_000       # tokens of a batch whose pairs are grouped together in a task
PIECE = 1 << 20              # bytes of a text split at a time
PART_CHARS = 16_000_000      # characters of text whose pairs one part holds, about
BROADCAST_WORDS = 12_000_000
START, END = np.uint64(0x5354415254000001), np.uint64(0x454E440000000002)
_SPACES = b" \t\n\x0b\x0c\r"


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 42)


def _words(text: str | None) -> Iterator[list[bytes]]:
    """Lower-case (A-Z) words of a text, a bounded piece at a time, pieces cut at white space."""
    data = (text or "").encode("utf-8", "surrogatepass")
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and data[end:end + 1] not in _SPACES:
            nearest = [p for p in (data.find(c, end, end + 4096) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if p >= 0]
            end = min(nearest) if nearest else end + 4096
        yield data[at:end].lower().split()
        at = end


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def _small(x: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest unsigned type."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


class _Batch:
    """Token pairs of some texts, by local word number."""

    def __init__(self):
        self.table: dict[bytes, int] = {}
        self.prev: list[np.ndarray] = []
        self.cur: list[np.ndarray] = []
        self.doc: list[int] = []
        self.size: list[int] = []
        self.train: list[bool] = []
        self.keys: list[int] = []
        self.n = 0

    def number(self, words: list[bytes]) -> np.ndarray:
        get = self.table.setdefault
        return np.array([get(w, len(self.table) + 2) for w in words], np.int32)

    def add(self, prev: np.ndarray, cur: np.ndarray, key: int, train: bool) -> None:
        self.prev.append(prev)
        self.cur.append(cur)
        self.size.append(len(cur))
        self.keys.append(key)
        self.train.append(train)
        self.n += len(cur)

    def hashes(self) -> np.ndarray:
        return np.concatenate(([START, END], np.fromiter(map(_hash, self.table), np.uint64, len(self.table))))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Columns of a few rows at a time: texts become Python strings piecemeal."""
    for b in batches:
        for lo in range(0, b.num_rows, 200):
            yield b.slice(lo, 200).to_pydict()


def _arrow(frames: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
    for f in frames:
        yield pa.RecordBatch.from_pandas(f, preserve_index=False)


def _batches(frames: Iterator[dict[str, list]], size: int) -> Iterator[_Batch]:
    """Batches of about ``size`` tokens from rows (key, train, text); long texts span several."""
    b = _Batch()
    for f in frames:
        for key, train, text in zip(f["key"], f["train"], f["text"], strict=True):
            last: bytes | None = None
            for words in _words(text):
                if not words:
                    continue
                cur = b.number(words)
                first = b.number([last]) if last is not None else np.zeros(1, np.int32)
                b.add(np.concatenate((first, cur[:-1])), cur, key, train)
                last = words[-1]
                if b.n >= size:
                    yield b
                    b = _Batch()
            first = b.number([last]) if last is not None else np.zeros(1, np.int32)
            b.add(first, np.ones(1, np.int32), key, train)
    if b.n:
        yield b


def _count_words(frames: Iterator[dict[str, list]], size: int) -> Iterator[pd.DataFrame]:
    for b in _batches(frames, size):
        cur, size_ = np.concatenate(b.cur), np.array(b.size)
        keep = np.repeat(np.array(b.train), size_)
        h = b.hashes()
        c = np.bincount(cur[keep], minlength=len(h))
        at = np.flatnonzero(c)
        yield pd.DataFrame({"h": h[at].view(np.int64), "c": c[at].astype(np.int64)})


def _named(h: np.ndarray, table) -> np.ndarray:
    """Words by their place in the broadcast table, where there is one: ``len`` for unknown words,
    ``len + 1`` for the start; else by hash."""
    if table is None:
        return h
    known = table[0]
    at = np.searchsorted(known, h)
    found = known[np.minimum(at, len(known) - 1)] == h if len(known) else np.zeros(len(h), bool)
    return np.where(h == START, len(known) + 1, np.where(found, at, len(known))).astype(np.uint64)


def _deal(frames: Iterator[dict[str, list]], size: int, parts: int, hot: np.ndarray, table) -> Iterator[pd.DataFrame]:
    """One row a batch and part: the pairs that belong there, with counts and documents."""
    hot = np.sort(_named(hot, table))
    for b in _batches(frames, size):
        h = _named(b.hashes(), table)
        if table is not None:  # unknown words are one word
            h, local = np.unique(h, return_inverse=True)
            pair = local[np.concatenate(b.prev)] * len(h) + local[np.concatenate(b.cur)]
        else:
            pair = np.concatenate(b.prev).astype(np.int64) * len(h) + np.concatenate(b.cur)
        doc = np.repeat(np.arange(len(b.size), dtype=np.int32), b.size)
        b.prev.clear()
        b.cur.clear()
        b.table.clear()
        order = np.argsort(pair, kind="stable")  # within a pair by document
        pair, doc = pair[order], doc[order]
        del order
        new_pair = np.r_[True, pair[1:] != pair[:-1]]
        post = np.flatnonzero(new_pair | np.r_[True, doc[1:] != doc[:-1]])
        mult = np.diff(np.r_[post, len(pair)]).astype(np.int32)
        first = np.flatnonzero(new_pair[post])  # postings where a pair starts
        pair, doc = pair[post][first], doc[post]
        n_post = np.diff(np.r_[first, len(doc)])
        trained = np.array(b.train)[doc] * mult
        n_train = np.add.reduceat(trained, first)
        h1, h2 = h[pair // len(h)], h[pair % len(h)]
        is_hot = hot[np.minimum(np.searchsorted(hot, h1), len(hot) - 1)] == h1 if len(hot) else np.zeros(len(h1), bool)
        part = (_mix(np.where(is_hot, h1 ^ _mix(h2), h1)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((h2, h1, part))
        part, h1, h2, n_train = part[order], h1[order], h2[order], n_train[order]
        old_first, n_post = first[order], n_post[order]
        new_first = np.cumsum(n_post) - n_post
        move = np.arange(len(doc)) - np.repeat(new_first - old_first, n_post)
        doc, mult = doc[move], mult[move]
        keys = np.array(b.keys, np.int64)
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
        rows = []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            p0, p1 = new_first[lo], new_first[hi - 1] + n_post[hi - 1]
            docs, local = np.unique(doc[p0:p1], return_inverse=True)
            heads = np.flatnonzero(np.r_[True, h1[lo + 1:hi] != h1[lo:hi - 1]])
            blob = pickle.dumps([_small(h1[lo:hi][heads]), _small(np.diff(np.r_[heads, hi - lo])), _small(h2[lo:hi]),
                                 _small(n_train[lo:hi]), _small(n_post[lo:hi]), _small(local),
                                 _small(mult[p0:p1]), keys[docs]], protocol=5)
            rows.append((int(part[lo]), blob))
        yield pd.DataFrame(rows, columns=["part", "blob"]).astype({"part": np.int32})


_RESULT = ("tag int, key long, ctx long, a1 long, a2 long, a3 long, a4 long, a5 long, n long, "
           "s0 double, s1 double")


def _frame(tag: int, **columns) -> pd.DataFrame:
    n = len(columns["key"])
    out = {"tag": np.full(n, tag, np.int32)}
    for name in [c.split()[0] for c in _RESULT.split(", ")][1:]:
        kind = np.float64 if name[0] == "s" else np.int64
        out[name] = np.asarray(columns.get(name, np.zeros(n)), kind)
    return pd.DataFrame(out)


def _joined(ready: dict[int, list[dict[str, np.ndarray]]]) -> Iterator[pd.DataFrame]:
    """The rows of several batches as one frame a tag; ``ready`` is emptied."""
    for tag, batches in ready.items():
        if batches:
            yield _frame(tag, **{k: np.concatenate([b[k] for b in batches]) for k in batches[0]})
            batches.clear()


def _score_part(blobs: list[bytes], hot: np.ndarray, hot_c: np.ndarray, table) -> Iterator[pd.DataFrame]:
    """All pairs of one part -> document sums (tag 0), context sums (1), unseen pairs (2 or 4) and,
    without the unigram table, seen pairs (3)."""
    got = [pickle.loads(x) for x in blobs]
    blobs.clear()
    h1 = np.concatenate([np.repeat(g[0], g[1]) for g in got])
    h2 = np.concatenate([g[2] for g in got])
    if table is not None:  # places in the table: both fit one number
        code = (h1.astype(np.uint64) << np.uint64(32)) | h2
        del h1, h2
        order = np.argsort(code, kind="stable").astype(np.int32)
        code = code[order]
        new = np.r_[True, code[1:] != code[:-1]]
        start = np.flatnonzero(new)
        u1, u2 = code[start] >> np.uint64(32), code[start] & np.uint64(0xFFFFFFFF)
        del code
    else:
        order = np.lexsort((h2, h1)).astype(np.int32)
        h1, h2 = h1[order].astype(np.uint64), h2[order].astype(np.uint64)
        new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        start = np.flatnonzero(new)
        u1, u2 = h1[start], h2[start]
        del h1, h2
    n_train = np.concatenate([g[3] for g in got])[order]
    r = np.add.reduceat(n_train, start, dtype=np.int64)  # count of each distinct pair
    pair_of = np.empty(len(order), np.int32)
    pair_of[order] = np.cumsum(new, dtype=np.int32) - 1
    del n_train, order, new, start
    new1 = np.r_[True, u1[1:] != u1[:-1]]
    ctx_start = np.flatnonzero(new1)
    ctx_of = np.cumsum(new1, dtype=np.int32) - 1
    c = np.add.reduceat(r, ctx_start)                    # count of each context, if all is here
    names = u1[ctx_start]
    del new1, ctx_start
    if table is not None:
        del u1
    if len(hot):
        at = np.minimum(np.searchsorted(hot, names), len(hot) - 1)
        c = np.where(hot[at] == names, hot_c[at], c)
    begin = START if table is None else np.uint64(len(table[0]) + 1)
    word = (names != begin)[ctx_of]
    seen, known = r > 0, (c > 0)[ctx_of]
    context = {f"a{k}": np.bincount(ctx_of[r == k], minlength=len(names)) for k in range(1, GT_MAX + 1)}
    context["n"] = np.bincount(ctx_of[r > GT_MAX], minlength=len(names))
    context["s1"] = np.bincount(ctx_of[r == GT_MAX + 1], minlength=len(names))
    context["ctx"] = c
    # What one occurrence of each pair adds to its document, as far as it is known here.
    gain = np.where(r > GT_MAX, np.log10(np.maximum(r - LARGE_DISCOUNT, 0.5)), 0.0)
    gain -= np.where(seen, np.log10(np.maximum(c, 1))[ctx_of], 0.0)
    if table is not None:
        p1 = table[1][u2.astype(np.int32)]
        context["s0"] = np.bincount(ctx_of[seen], weights=p1[seen], minlength=len(names))
        lp = np.log10(p1)
        gain = np.where(seen | known, gain, lp)
        del p1
    plain = np.where(word, np.log10(c + 1.0)[ctx_of], 0.0)
    at, held = 0, 0
    ready: dict[int, list[dict[str, np.ndarray]]] = {0: [], 2: [], 4: []}
    for g in got:  # one batch's documents at a time
        p = np.repeat(pair_of[at:at + len(g[2])], g[4])
        at += len(g[2])
        doc, mult, keys = g[5].astype(np.int64), g[6].astype(np.int64), g[7]
        n = len(keys)
        rp = r[p]
        sums = {f"a{k}": np.bincount(doc[rp == k], weights=mult[rp == k], minlength=n) for k in range(1, GT_MAX + 1)}
        sums["s0"] = np.bincount(doc, weights=mult * gain[p], minlength=n)
        sums["s1"] = np.bincount(doc, weights=mult * plain[p], minlength=n)
        sums["n"] = np.bincount(doc, weights=mult, minlength=n)
        sums["ctx"] = np.bincount(doc, weights=mult * (word & known)[p], minlength=n)
        ready[0].append({"key": keys, **sums})
        held += n
        if table is not None:
            q = np.flatnonzero((rp == 0) & known[p])
            pairs, inverse = np.unique(doc[q] * len(names) + ctx_of[p[q]], return_inverse=True)
            ready[2].append({"key": keys[pairs // len(names)], "ctx": names[pairs % len(names)].view(np.int64),
                             "s0": np.bincount(inverse, weights=lp[p[q]] * mult[q], minlength=len(pairs)),
                             "n": np.bincount(inverse, weights=mult[q], minlength=len(pairs))})
        else:
            q = np.flatnonzero(rp == 0)
            ready[4].append({"key": keys[doc[q]], "ctx": u1[p[q]].view(np.int64), "a1": u2[p[q]].view(np.int64), "n": mult[q]})
        held += len(q)
        if held > 50_000:
            yield from _joined(ready)
            held = 0
    yield from _joined(ready)
    if table is None:
        at = np.flatnonzero(seen)
        yield _frame(3, key=u1[at].view(np.int64), ctx=u2[at].view(np.int64))
    at = c > 0
    yield _frame(1, key=names[at].view(np.int64), **{k: v[at] for k, v in context.items()})


def _score(frames: Iterator[pd.DataFrame], hot: np.ndarray, hot_c: np.ndarray, table) -> Iterator[pd.DataFrame]:
    """Rows (part, blob) in the order of parts -> the results of each part."""
    hot = _named(hot, table)
    order = np.argsort(hot)
    hot, hot_c = hot[order], hot_c[order]
    part, blobs = None, []
    for f in frames:
        for p, blob in zip(f["part"], f["blob"], strict=True):
            if p != part and blobs:
                yield from _score_part(blobs, hot, hot_c, table)
                blobs = []
            part = p
            blobs.append(blob)
    if blobs:
        yield from _score_part(blobs, hot, hot_c, table)


def discounts(counts_of_counts: list[int]) -> list[float]:
    """d(1) .. d(GT_MAX) from n(1) .. n(GT_MAX + 1); half a count off where Katz's formula fails."""
    n = [0, *counts_of_counts]
    out = []
    tail = (GT_MAX + 1) * n[GT_MAX + 1] / n[1] if n[1] else 1.0
    for r in range(1, GT_MAX + 1):
        d = math.nan
        if n[r] and tail < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail)
        out.append(d if 0 < d < 1 else (r - 0.5) / r)
    return out


def lm_scores(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", parts: int | None = None,
              broadcast_words: int = BROADCAST_WORDS, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row a document."""
    spark = docs.sparkSession
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    key = F.xxhash64(name, text_or_empty(text))
    if docs.schema[doc_id].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
        ids = docs.agg(F.count("*"), F.count(doc_id), F.count_distinct(doc_id)).first()
        if ids[0] == ids[1] == ids[2]:  # ids that name their row are shorter than hashes
            key = F.col(doc_id).cast("long")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), key.alias("key"),
        (F.crc32(name.cast("binary")) % FOLDS != HELD_OUT).alias("train"), text_or_empty(text).alias("text"))
    tokens = rows.select("key", "train", "text")

    # The unigram model.
    vocab = written(tokens.filter("train").mapInArrow(lambda it: _arrow(_count_words(_rows(it), batch_tokens)), "h long, c long")
                    .groupBy("h").agg(F.sum("c").alias("c")))
    spec = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("N"), F.count("*").alias("V"), *[
        F.count(F.when(F.col("c") == r, 1)).alias(f"n{r}") for r in range(1, GT_MAX + 2)],
        F.coalesce(F.sum(F.when(F.col("h") == int(END.view(np.int64)), F.col("c"))), F.lit(0)).alias("ends")).first()
    total, words = spec["N"], spec["V"]
    d1 = discounts([spec[f"n{r}"] for r in range(1, GT_MAX + 2)])
    factor = F.element_at(F.array(*[F.lit(d) for d in d1]), F.least(F.col("c"), F.lit(GT_MAX)).cast("int"))
    kept = F.when(F.col("c") <= GT_MAX, F.col("c") * factor).otherwise(F.col("c") - LARGE_DISCOUNT)
    chance = vocab.select("h", (kept / float(max(total, 1))).alias("p1"))
    lost = sum(spec[f"n{r}"] * r * (1 - d1[r - 1]) for r in range(1, GT_MAX + 1))
    lost += LARGE_DISCOUNT * (words - sum(spec[f"n{r}"] for r in range(1, GT_MAX + 1)))
    unknown = lost / total if total else 1.0

    # Pairs dealt to parts and scored there.
    if parts is None:
        chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(chars / PART_CHARS))
    frequent = sorted((np.int64(h).view(np.uint64), c) for h, c in vocab.filter(F.col("c") > total / (4 * parts)).collect())
    hot, hot_c = np.array([h for h, _ in frequent], np.uint64), np.array([c for _, c in frequent], np.int64)
    start_c = rows.filter("train").count()
    if start_c:  # every text starts once
        hot, hot_c = np.append(hot, START), np.append(hot_c, start_c)
        order = np.argsort(hot)
        hot, hot_c = hot[order], hot_c[order]
    table = None
    if words <= broadcast_words:
        local = chance.toArrow()
        h = local["h"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        p1 = np.append(local["p1"].to_numpy()[order], [unknown, unknown])  # unknown words, the start
        table = spark.sparkContext.broadcast((h[order], p1))
        del local, h
    dealt = tokens.mapInArrow(
        lambda it: _arrow(_deal(_rows(it), batch_tokens, parts, hot, table.value if table is not None else None)),
        "part int, blob binary")
    scored = written(dealt.repartition(parts, "part").sortWithinPartitions("part").mapInPandas(
        lambda it: _score(it, hot, hot_c, table.value if table is not None else None), _RESULT))

    shared = table is not None
    if shared:  # what follows reads the written results
        table.destroy()

    # Discounts of pairs, then backoff weights of contexts.
    ctx = scored.filter("tag = 1")
    grouped = ctx.groupBy(F.col("key").alias("h")).agg(
        F.max("ctx").alias("c"), *[F.sum(f"a{r}").alias(f"a{r}") for r in range(1, GT_MAX + 1)],
        F.sum("n").alias("large"), F.sum("s0").alias("seen_p1"))
    spectrum = ctx.agg(*[F.sum(f"a{r}") for r in range(1, GT_MAX + 1)], F.sum("s1")).first()
    d2 = discounts([int(x or 0) for x in spectrum])
    if not shared:
        found = scored.filter("tag = 3").select("key", "ctx").join(chance, F.col("ctx") == F.col("h"), "left")
        s = found.groupBy("key").agg(F.sum(F.coalesce("p1", F.lit(unknown))).alias("s"))
        grouped = grouped.join(s, grouped["h"] == s["key"]).withColumn("seen_p1", F.col("s"))
    lost2 = F.lit(LARGE_DISCOUNT) * F.col("large")
    for r in range(1, GT_MAX + 1):
        lost2 = lost2 + F.col(f"a{r}") * (r * (1 - d2[r - 1]))
    weights = grouped.select(F.col("h").alias("w_h"), F.log10(lost2 / F.col("c") / (1 - F.col("seen_p1"))).alias("log_alpha"))

    # Sums of each document.
    if shared:
        unseen = scored.filter("tag = 2").select("key", "ctx", "s0", "n")
    else:
        raw = scored.filter("tag = 4").select("key", "ctx", F.col("a1").alias("word"), "n")
        unseen = raw.join(chance, F.col("word") == F.col("h"), "left").select(
            "key", "ctx", (F.col("n") * F.log10(F.coalesce("p1", F.lit(unknown)))).alias("s0"), "n")
    backed = unseen.join(weights, F.col("ctx") == F.col("w_h"), "left").select(
        "key", (F.col("s0") + F.col("n") * F.coalesce("log_alpha", F.lit(0.0))).alias("score"),
        F.lit(0.0).alias("base"), F.lit(0).cast("long").alias("tokens"), F.lit(0).cast("long").alias("known"))
    score = F.col("s0")
    for r in range(1, GT_MAX + 1):
        score = score + F.col(f"a{r}") * math.log10(d2[r - 1] * r)
    own = scored.filter("tag = 0").select("key", score.alias("score"), F.col("s1").alias("base"),
                                          F.col("n").alias("tokens"), F.col("ctx").alias("known"))
    sums = own.unionByName(backed).groupBy("key").agg(*[F.sum(x).alias(x) for x in ("score", "base", "tokens", "known")])
    flat = rows.select("doc_id", "key", "train")
    again = flat.groupBy("key").agg(F.count("*").alias("rows"))  # rows alike share their sums
    per = sums.join(again, "key").select(
        F.col("key").alias("k"), *[(F.col(x) / F.col("rows")).alias(x) for x in ("score", "base")],
        *[(F.col(x) / F.col("rows")).cast("long").alias(x) for x in ("tokens", "known")])
    ends = spec["ends"]
    return flat.join(per, F.col("key") == F.col("k")).select(
        "doc_id", (~F.col("train")).alias("held_out"), F.col("tokens").alias("n_tokens"),
        (F.col("known") + int(ends > 0)).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + math.log10(ends + 1) - F.col("tokens") * math.log10(total + words + 1)).alias("base_score"),
        "score")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read(spark, sf_dir, "documents").select("doc_id", "text"))

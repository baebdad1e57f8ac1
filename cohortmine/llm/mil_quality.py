"""Quality classifier (operator 13): attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Every passage is encoded: shares of
byte classes, statistics of its words and hashed counts of words and word ends, then a learned
layer. Gated attention (a tanh branch times a sigmoid gate) weighs the passages of a bag, the
weighted sum of their encodings is scored by a logistic unit. Only the document has a label; what
weighs in it, and how, is learned by back-propagation through the attention.

The model is fitted on a bounded sample of the labelled rows of the training fold: the first
``SAMPLE_DOCS`` labelled ids by hash, and of those as many whole documents as have
``SAMPLE_PASSAGES`` passages together. Scoring reads every whole text once, in one pass without a
shuffle; no column but the text enters a score.

Defined cases: a null text is empty, an empty text is one passage without words and gets the score
learned for such; ids with several labels train on the majority (a tie counts as 1); labels
without a quality and null ids are not learned from; repeated documents of an id train once and
score alike; without labels the score is 0.5, with labels of one class that class; texts of more
than ``BLOCK`` bytes are cut into blocks between words, and every passage of each is used; other
columns are carried, clashing names give way to the result's; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortmine.llm.common import checkpointed, own_columns, quoted, read

PASSAGE_WORDS = 64
SAMPLE_DOCS = 6000
SAMPLE_PASSAGES = 60_000
FOLDS, HELD_FOLD = 5, 0
THRESHOLD = 0.3
HIDDEN, GATE = 32, 16
EPOCHS, BATCH, RATE, DECAY = 24, 128, 0.01, 1e-4
BLOCK = 1 << 20  # bytes encoded at a time

# The byte classes whose shares describe a passage.
_CLASSES = [b"\n", b"\t\x0b\x0c\r ", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".", b",", b"!?",
            b"#*$%&|<>", b";:'\"()-", b"+/=@[\\]^_`{}~", bytes(range(128, 256))]
_WORD_BUCKETS, _END_BUCKETS, _STATS = 128, 64, 9
FEATURES = len(_CLASSES) + _STATS + _WORD_BUCKETS + _END_BUCKETS

_CLASS = np.zeros(256, np.int64)
for _number, _members in enumerate(_CLASSES):
    _CLASS[list(_members)] = _number
_SPACE = np.isin(np.arange(256), list(b"\x20\x09\x0a\x0b\x0c\x0d"))
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return ((h ^ (h >> np.uint64(29))) % np.uint64(n)).astype(np.int64)


def _blocks(text: bytes) -> list[bytes]:
    """The text in blocks of about ``BLOCK`` bytes that end between words."""
    if len(text) <= BLOCK:
        return [text]
    out, start = [], 0
    while start < len(text):
        end = start + BLOCK
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        out.append(text[start:end])
        start = end
    return out


def _encode_group(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = b" ".join(texts) + b" "
    code = np.frombuffer(data, np.uint8)
    begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
    space = _SPACE[code]
    start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    end = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
    text_of = np.searchsorted(begins, start, "right") - 1
    n_words = np.bincount(text_of, minlength=len(texts))
    bags = np.maximum(-(-n_words // PASSAGE_WORDS), 1)
    first = np.cumsum(bags) - bags
    word_first = np.cumsum(n_words) - n_words
    where = first[text_of] + (np.arange(len(start)) - word_first[text_of]) // PASSAGE_WORDS
    total = int(bags.sum())
    out = np.zeros((total, FEATURES), np.float32)
    if not len(start):
        return out, bags

    words = np.bincount(where, minlength=total).astype(np.float64)
    held = np.maximum(words, 1)
    reach = np.append(start[1:], len(code)) - start  # a word and the spaces after it
    of_byte = np.repeat(where, reach)
    shares = np.bincount(of_byte * len(_CLASSES) + _CLASS[code[start[0]:]], minlength=total * len(_CLASSES))
    shares = shares.reshape(total, -1).astype(np.float64)
    out[:, :len(_CLASSES)] = shares / np.maximum(shares.sum(1, keepdims=True), 1)

    power, inverse = _powers(_BASE, len(code)), _powers(_INVERSE, len(code))
    rolled = np.concatenate([[np.uint64(0)], np.cumsum(_LOWER[code] * power, dtype=np.uint64)])

    def hashed(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (rolled[hi] - rolled[lo]) * inverse[lo]

    whole, ending = hashed(start, end), hashed(np.maximum(start, end - 3), end)
    length = (end - start).astype(np.float64)
    same = np.concatenate([[False], (whole[1:] == whole[:-1]) & (where[1:] == where[:-1])])
    order = np.lexsort((whole, where))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (whole[order][1:] != whole[order][:-1]) | (where[order][1:] != where[order][:-1])
    capital, last = _CLASS[code[start]] == 3, _CLASS[code[end - 1]]
    upper = np.concatenate([[0], np.cumsum(_CLASS[code] == 3)])
    shouted = (upper[end] - upper[start] >= 2) & (2 * (upper[end] - upper[start]) > length)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(where, values, minlength=total) / held

    at = len(_CLASSES)
    stats = [words / PASSAGE_WORDS, (words == 0).astype(float), np.log1p(mean(length)), np.log1p(mean(length * length)),
             mean(same), np.bincount(where[order], fresh, minlength=total) / held, mean(capital), mean(shouted),
             mean((last == 7) | (last == 8))]
    out[:, at:at + _STATS] = np.stack(stats, 1)
    at += _STATS
    for value, size in ((whole, _WORD_BUCKETS), (ending, _END_BUCKETS)):
        counts = np.bincount(where * size + _bucket(value, size), minlength=total * size).reshape(total, size)
        out[:, at:at + size] = np.sqrt(counts / held[:, None])
        at += size
    return out, bags


def encode(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, number of passages per text) of groups of the texts, in order; memory is bounded by a group.

    A text of several blocks is a group of its own.
    """
    group, held = [], 0
    for text in texts:
        if group and held + len(text) > BLOCK:
            yield _encode_group(group)
            group, held = [], 0
        if len(text) > BLOCK:
            parts = [_encode_group([b])[0] for b in _blocks(text)]
            yield np.concatenate(parts), np.array([sum(map(len, parts))])
            continue
        group.append(text)
        held += len(text)
    if group:
        yield _encode_group(group)


class GatedAttention:
    """Gated attention pooling over encoded passages and a logistic unit."""

    def __init__(self, features: int = FEATURES, hidden: int = HIDDEN, gate: int = GATE, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)

        def around(rows: int, cols: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(rows), (rows, cols))

        self.center, self.scale = np.zeros(features), np.ones(features)
        self.p = {"W": around(features, hidden), "b": np.zeros(hidden), "V": around(hidden, gate), "U": around(hidden, gate),
                  "w": around(gate, 1)[:, 0], "c": around(hidden, 1)[:, 0], "d": np.zeros(1)}

    def forward(self, x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        first = np.cumsum(bags) - bags
        of = np.repeat(np.arange(len(bags)), bags)
        h = np.tanh(((x - self.center) / self.scale) @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, first)[of])
        a = e / np.add.reduceat(e, first)[of]
        z = np.add.reduceat(a[:, None] * h, first)
        score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"][0], -60, 60)))
        return {"first": first, "of": of, "h": h, "t": t, "s": s, "a": a, "z": z, "score": score}

    def gradient(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy."""
        p, f = self.p, self.forward(x, bags)
        of, h, t, s, a, z = (f[k] for k in ("of", "h", "t", "s", "a", "z"))
        out = (f["score"] - y) / len(y)
        dz = out[:, None] * p["c"]
        da = (dz[of] * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, f["first"])[of])
        dts = de[:, None] * p["w"]
        dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
        dh = a[:, None] * dz[of] + dt @ p["V"].T + ds @ p["U"].T
        pre = dh * (1 - h * h)
        return {"W": ((x - self.center) / self.scale).T @ pre, "b": pre.sum(0), "V": h.T @ dt, "U": h.T @ ds,
                "w": (t * s).T @ de, "c": z.T @ out, "d": np.array([out.sum()])}

    def fit(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH,
            rate: float = RATE, decay: float = DECAY, seed: int = 7) -> GatedAttention:
        """Adam over shuffled batches of bags; the same rows give the same model."""
        self.center, self.scale = x.mean(0, dtype=np.float64), x.std(0, dtype=np.float64) + 1e-3
        rng = np.random.default_rng(seed)
        first = np.cumsum(bags) - bags
        m, v = ({k: np.zeros_like(w) for k, w in self.p.items()} for _ in range(2))
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(bags))
            for lo in range(0, len(order), batch):
                mine = np.sort(order[lo:lo + batch])
                rows = np.concatenate([np.arange(first[i], first[i] + bags[i]) for i in mine.tolist()])
                step += 1
                slow = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
                for k, g in self.gradient(x[rows], bags[mine], y[mine]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    w = (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
                    self.p[k] = self.p[k] - slow * (w + decay * self.p[k])
        return self

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Scores of whole texts, to six places: beyond them the batch that a text is in would show."""
        parts = [self.forward(x, bags)["score"] for x, bags in encode(texts)]
        return np.round(np.concatenate(parts), 6) if parts else np.zeros(0)


class Constant:
    """The model where there is nothing to learn from."""

    def __init__(self, value: float) -> None:
        self.value = value

    def score(self, texts: list[bytes]) -> np.ndarray:
        return np.full(len(texts), self.value)


def _held(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_FOLD, F.lit(False))


def sample_bags(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
                sample_docs: int = SAMPLE_DOCS, sample_passages: int = SAMPLE_PASSAGES) -> DataFrame:
    """(y, n, x): label, passages and features of the bounded training sample, in a fixed order."""
    key = labels.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(label)).cast("double").alias("y"))
    taught = key.filter(F.col("id").isNotNull() & F.col("y").isNotNull() & ~_held(F.col("id"))).groupBy("id").agg(
        F.avg("y").alias("y")).select("id", (F.col("y") >= 0.5).cast("double").alias("y"), F.xxhash64("id").alias("o"))
    chosen = checkpointed(taught.orderBy("o", "id").limit(sample_docs))  # bounded, so it may be broadcast
    source = docs.select(F.col(quoted(doc_id)).alias("doc"), F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).alias("text"))
    rows = source.join(F.broadcast(chosen), F.col("doc") == F.col("id")).select("o", "id", "y", F.xxhash64("text").alias("t"), "text")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [v.as_buffer().to_pybytes() for v in batch.column(batch.num_columns - 1)]
            at = 0
            for x, sizes in encode(texts):
                cut = np.cumsum(sizes)[:-1]
                whole = batch.slice(at, len(sizes)).columns[:-1]
                at += len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [*whole, pa.array(sizes.astype(np.int64)), pa.array([p.tobytes() for p in np.split(x, cut)], pa.binary())],
                    ["o", "id", "y", "t", "n", "x"])

    kind = docs.schema[doc_id].dataType.simpleString()
    found = rows.mapInArrow(bags, f"o long, id {kind}, y double, t long, n long, x binary")
    one = found.groupBy("o", "id").agg(F.min(F.struct("t", "y", "n", "x")).alias("r")).select("o", "id", "r.y", "r.n", "r.x")
    held = checkpointed(one)  # at most sample_docs rows
    running = held.select("o", "id", "n").withColumn("upto", F.sum("n").over(Window.orderBy("o", "id")))
    fits = running.filter(F.col("upto") <= sample_passages).select("o", "id")
    return held.join(F.broadcast(fits), ["o", "id"]).orderBy("o", "id").select("y", "n", "x")


def train(docs: DataFrame, labels: DataFrame, **how) -> GatedAttention | Constant:
    """The model of a bounded sample of labelled documents outside the held-out fold."""
    table = sample_bags(docs, labels, **how).toArrow()
    y = table.column("y").to_numpy()
    if not len(y):
        return Constant(0.5)
    if y.min() == y.max():
        return Constant(float(y[0]))
    x = np.frombuffer(b"".join(table.column("x").to_pylist()), np.float32).reshape(-1, FEATURES)
    return GatedAttention().fit(x, table.column("n").to_numpy(), y)


def scored(docs: DataFrame, model: GatedAttention | Constant, text: str = "text", doc_id: str = "doc_id",
           threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the text, with ``held_out``, ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(shared.value.score([(t or "").encode() for t in batch]))

    own = own_columns(docs, (text, "held_out", "score", "predicted"))
    rows = docs.select(*own, score(F.col(quoted(text)).cast("string")).alias("score"), _held(F.col(quoted(doc_id))).alias("held_out"))
    return rows.select(*own, "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """Train on ``labels`` and score every document."""
    return scored(docs, train(docs, labels, text=text, doc_id=doc_id, **how), text, doc_id)


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_scores(docs, read(spark, sf_dir, "labels").select("doc_id", "quality"))

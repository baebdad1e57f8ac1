"""Phrase collocation mining (operator 11): HAT-trie counting of phrases, exact scores.

Texts (A-Z lower-cased) are cut into pieces at punctuation and line ends, pieces into words. Each
task counts phrases in a :class:`HatTrie`: a shallow trie over word ids whose leaves are hash
containers that burst when they grow. When a trie holds ``TRIE_ENTRIES`` entries its largest
subtrees are spilled whole, as runs sorted by word; Spark deals the runs by prefix (language and
first two words) and merges them there by keyed sums. A task's memory is thereby bounded whatever
the size and variety of its texts.

All parts of a phrase occur at least as often as the phrase. So three
passes read the texts: for words; for pairs of frequent words, by hash; and for pairs and triples
that the frequent pairs let through. A pass knows the frequent phrases of the one before by a
bitmap of bounded size (:class:`FrequentFilter`); it lets some others pass, whose exact counts are
under ``min_count`` and drop them at the merge. What follows is joins of the small table left.

Defined cases: a null text is empty; a null language is ``und``; rows that repeat count again, as
their words do occur again; the whole text is counted, however long; columns other than text and
language are not read, so their names cannot clash; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortmine.llm.common import quoted, read, written

MIN_COUNT = 10        # least occurrences of a candidate
TOP = 2000            # phrases returned per language
HIDDEN_PERCENT = 50   # a longer candidate with this share of the occurrences hides its parts
TRIE_ENTRIES = 2_000_000
BURST = 16_384
SPILL_TREES = 256
VOCABULARY = 1 << 19  # words of a task before it spills everything and starts a new table
BLOCK = 1 << 21       # bytes counted at a time
ROWS_A_BATCH = 1 << 14
FILTER_SLOTS = 16     # bits a frequent phrase in the filter for the next length
FILTER_BITS = 1 << 27  # 16 MiB at most

_ID_BITS = 21
_FIRST = 2 * _ID_BITS
_DIGIT = _FIRST + 8
_PHRASE = "lang string, w1 string, w2 string, w3 string, n long"
# A-Z to a-z, piece ends to a full stop, tab to a space; all other bytes stay.
_MAP = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"." * 10 + b" ")
_END = b"."  # no word holds one


class HatTrie:
    """Counts of sequences of one to three word ids, packed into a number (0 fills missing places).

    The root maps the high digit of the first word's id to a container, a dict from the packed
    sequence to its count. A container beyond ``BURST`` entries bursts into a node: containers by
    the whole first word.
    """

    def __init__(self) -> None:
        self.roots: dict[int, dict] = {}
        self.burst: set[int] = set()
        self.size: dict[int, int] = {}

    def add(self, keys: np.ndarray, counts: np.ndarray) -> int:
        """Add counted sequences, sorted; how many entries are new."""
        grown = 0
        for digit, lo, hi in _runs(keys >> _DIGIT):
            before = after = self.size.get(digit, 0)
            tree = self.roots.setdefault(digit, {})
            if digit in self.burst:
                for word, i, j in _runs(keys[lo:hi] >> _FIRST):
                    box = tree.setdefault(word, {})
                    after += _into_box(box, keys[lo + i:lo + j], counts[lo + i:lo + j])
            else:
                after += _into_box(tree, keys[lo:hi], counts[lo:hi])
                if after > BURST:
                    self._burst(digit, tree)
            self.size[digit] = after
            grown += after - before
        return grown

    def _burst(self, digit: int, box: dict) -> None:
        node: dict[int, dict] = {}
        for key, count in box.items():
            node.setdefault(key >> _FIRST, {})[key] = count
        self.roots[digit] = node
        self.burst.add(digit)

    def take(self, digit: int) -> tuple[np.ndarray, np.ndarray]:
        """Remove the whole subtree of a digit: its sequences and their counts."""
        tree = self.roots.pop(digit)
        boxes = list(tree.values()) if digit in self.burst else [tree]
        self.burst.discard(digit)
        n = self.size.pop(digit)
        return (np.fromiter((k for box in boxes for k in box), np.int64, n),
                np.fromiter((c for box in boxes for c in box.values()), np.int64, n))


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of the runs of a sorted array."""
    edge = np.flatnonzero(np.diff(values, prepend=-1))
    return zip(values[edge].tolist(), edge.tolist(), [*edge[1:].tolist(), len(values)], strict=True)


def _into_box(box: dict, keys: np.ndarray, counts: np.ndarray) -> int:
    """How many keys are new."""
    before = len(box)
    if not before:
        box.update(zip(keys.tolist(), counts.tolist(), strict=True))
        return len(box)
    get = box.get
    for key, count in zip(keys.tolist(), counts.tolist(), strict=True):
        box[key] = get(key, 0) + count
    return len(box) - before


def _blocks(data: bytes, block: int = BLOCK) -> Iterator[bytes]:
    """The bytes in parts of about ``block`` that end between words."""
    start = 0
    while start < len(data):
        end = data.find(b" ", start + block)
        end = len(data) if end < 0 else end
        yield data[start:end]
        start = end


class FrequentFilter:
    """A bitmap over the hashes of frequent phrases: no frequent phrase is missed, few others pass.

    Phrases hash by their words' hashes, mixed by place, so tasks look up whole arrays of ids.
    """

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes & self.mask).astype(np.int64)
        return (self.bits[slot >> 3] >> (slot & 7)) & 1 == 1


def _word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, seed=11)


def _mixed(lang: str, words: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases from arrays of their words' hashes, one array a place."""
    h = np.full(len(words[0]), _word_hash(lang.encode()), np.uint64)
    for w in words:
        h = (h ^ w) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


class PhraseCounter:
    """Counts of one task: a trie for each language over one word table.

    Pass 1 counts words. Pass 2 counts pairs of words that pass ``known``, the filter of frequent
    words, and sends them by hash. Pass 3 counts pairs that pass ``known``, now the filter of
    frequent pairs, and triples both of whose pairs do: a triple's place counts for its pair too.
    """

    def __init__(self, turn: int, known: FrequentFilter | None = None, entries: int = TRIE_ENTRIES,
                 vocabulary: int = VOCABULARY, block: int = BLOCK) -> None:
        self.turn, self.known = turn, known
        self.limit, self.words_limit, self.block = entries, vocabulary, block
        self.tries: dict[str, HatTrie] = {}
        self.totals: Counter[str] = Counter()
        self.entries = 0
        self._new_words()

    def _new_words(self) -> None:
        self.ids: dict[bytes, int] = defaultdict(count().__next__)
        self.ids[_END]  # id 0
        self.hashes = np.zeros(1, np.uint64)

    def add(self, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        """Count a text; yields runs of subtrees that had to be spilled."""
        marked = text.translate(_MAP).replace(_END, b" " + _END + b" ")
        before: list[bytes] = []  # the last words of the block before
        for part in _blocks(marked, self.block):
            words = before + part.split()
            # places whose next words are not known yet wait for the next block
            done = max(0, len(words) - (self.turn - 1))
            self._count(lang, words, done)
            before = words[done:]
            if len(self.ids) > self.words_limit:
                yield from self.spill(everything=True)
                self._new_words()
            elif self.entries > self.limit:
                yield from self.spill()
        self._count(lang, before + [_END] * (self.turn - 1), len(before))

    def _count(self, lang: str, words: list[bytes], places: int) -> None:
        """Count the phrases that start at the first ``places`` words."""
        if not places:
            return
        numbers = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        if self.turn == 1:
            key = numbers[numbers > 0]
            self.totals[lang] += len(key)
            key <<= _FIRST
        else:
            if len(self.ids) > len(self.hashes):
                fresh = list(islice(self.ids, len(self.hashes), None))
                self.hashes = np.concatenate([self.hashes, np.fromiter(map(_word_hash, fresh), np.uint64, len(fresh))])
            good = numbers > 0
            hashed = self.hashes[numbers]
            if self.turn == 2:
                good &= self.known.has(_mixed(lang, [hashed]))
                pair = (good[:-1] & good[1:])[:places]
                key = ((numbers[:-1] << _FIRST) | (numbers[1:] << _ID_BITS))[:places][pair]
            else:
                pair = good[:-1] & good[1:]
                pair &= self.known.has(_mixed(lang, [hashed[:-1], hashed[1:]]))
                third = np.where(pair[1:places + 1], numbers[2:places + 2], 0)
                key = ((numbers[:places] << _FIRST) | (numbers[1:places + 1] << _ID_BITS) | third)[pair[:places]]
        if len(key):
            self.entries += self.tries.setdefault(lang, HatTrie()).add(*np.unique(key, return_counts=True))

    def spill(self, everything: bool = False) -> Iterator[pa.RecordBatch]:
        """Whole subtrees as sorted runs: all, or the largest until half of the entries are left."""
        trees = sorted(((n, lang, digit) for lang, trie in self.tries.items() for digit, n in trie.size.items()),
                       key=lambda x: (-x[0], x[1], x[2]))
        aim, chosen = (0 if everything else self.limit // 2), {}
        left = self.entries
        for n, lang, digit in trees:
            if not everything and left <= aim:
                break
            chosen.setdefault(lang, []).append(digit)
            left -= n
        self.entries = left
        names = list(self.ids)
        for lang, digits in chosen.items():
            for lo in range(0, len(digits), SPILL_TREES):
                taken = [self.tries[lang].take(d) for d in digits[lo:lo + SPILL_TREES]]
                yield from self._run(lang, np.concatenate([k for k, _ in taken]), np.concatenate([c for _, c in taken]), names)
        if everything:
            self.tries = {}

    def _run(self, lang: str, keys: np.ndarray, counts: np.ndarray, names: list[bytes]) -> Iterator[pa.RecordBatch]:
        low = (1 << _ID_BITS) - 1
        places = [keys >> _FIRST, (keys >> _ID_BITS) & low, keys & low]
        if self.turn == 2:
            h = _mixed(lang, [self.hashes[p] for p in places[:2]]).view(np.int64)
            order = np.argsort(h)
            for lo in range(0, len(h), ROWS_A_BATCH):
                yield pa.RecordBatch.from_arrays([pa.array(x[order[lo:lo + ROWS_A_BATCH]]) for x in (h, counts)], ["h", "n"])
            return
        used = np.unique(np.concatenate([*places, [0]]))
        order = sorted(used[1:].tolist(), key=names.__getitem__)
        rank = np.zeros(int(used[-1]) + 1, np.int64)  # 0: no word
        rank[order] = np.arange(1, len(order) + 1)
        a, b, c = (rank[p] for p in places)
        by = np.lexsort((c, b, a))
        a, b, c, counts = a[by], b[by], c[by], counts[by]
        named = pa.array([names[i].decode() for i in order], pa.string())
        if self.turn == 1:
            yield from _phrase_rows(lang, named, [a, b, c], counts)
            return
        pair = np.flatnonzero((np.diff(a, prepend=-1) != 0) | (np.diff(b, prepend=-1) != 0))
        yield from _phrase_rows(lang, named, [a[pair], b[pair], np.zeros_like(pair)], np.add.reduceat(counts, pair))
        yield from _phrase_rows(lang, named, [p[c > 0] for p in (a, b, c)], counts[c > 0])

    def finish(self) -> Iterator[pa.RecordBatch]:
        """All that is left, and the languages' numbers of words."""
        yield from self.spill(everything=True)
        for lang, n in self.totals.items():
            yield from _phrase_rows(lang, pa.array([""], pa.string()), [np.zeros(1, np.int64)] * 3, np.array([n]))


def _phrase_rows(lang: str, named: pa.Array, places: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(counts), ROWS_A_BATCH):
        hi = min(lo + ROWS_A_BATCH, len(counts))
        words = [named.take(pa.array(np.maximum(p[lo:hi] - 1, 0), mask=p[lo:hi] == 0)) for p in places]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (hi - lo), pa.string()), *words, pa.array(counts[lo:hi])], ["lang", "w1", "w2", "w3", "n"])


def phrase_runs(docs: DataFrame, turn: int, known: FrequentFilter | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """Spilled runs of the tasks' tries: (lang, w1, w2, w3, n), a row without words counting all
    words, or (h, n) in pass 2."""
    source = docs.select(F.coalesce(F.col(quoted(lang)).cast("string"), F.lit("und")).alias("lang"),
                         F.col(quoted(text)).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def count_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PhraseCounter(turn, shared.value)
        for batch in batches:
            groups: dict[str, list[bytes]] = {}
            held = 0
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if value.is_valid:
                    groups.setdefault(name, []).append(value.as_buffer().to_pybytes())
                    held += len(groups[name][-1])
                if held > BLOCK:
                    for each, texts in groups.items():
                        yield from counter.add(each, b"\n".join(texts))
                    groups, held = {}, 0
            for each, texts in groups.items():
                yield from counter.add(each, b"\n".join(texts))
        yield from counter.finish()

    return source.mapInArrow(count_phrases, "h long, n long" if turn == 2 else _PHRASE)


def _word_slots(words: DataFrame) -> DataFrame:
    """(h): the hashes of counted words."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            word = np.array([_word_hash(w.encode()) for w in batch.column(1).to_pylist()], np.uint64)
            h = np.zeros(len(langs), np.uint64)
            for lang in set(langs):
                mine = langs == lang
                h[mine] = _mixed(lang, [word[mine]])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    return words.mapInArrow(slots, "h long")


def _filter_of(hashes: DataFrame, slots_a_phrase: int = FILTER_SLOTS, largest: int = FILTER_BITS) -> FrequentFilter:
    """The filter of a table of hashes: ``FILTER_SLOTS`` bits each, at most ``FILTER_BITS`` in all.

    Its size is bounded whatever the corpus; a full filter lets more phrases pass, none less.
    """
    bits = 1 << 15
    n = hashes.count()
    while bits < min(n * slots_a_phrase, largest):
        bits *= 2
    slot = F.col("h").bitwiseAND(F.lit(bits - 1))
    where = hashes.select(F.floor(slot / 32768).alias("bucket"), (slot % 32768).alias("at"))
    packed = where.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")).toArrow()
    out = np.zeros(bits // 8, np.uint8)
    for bucket, part in zip(packed.column(0).to_pylist(), packed.column(1).to_pylist(), strict=True):
        out[bucket * 4096:(bucket + 1) * 4096] = np.frombuffer(part, np.uint8)
    return FrequentFilter(out)


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, w1, w2, w3, n): phrases of one to three words with ``min_count`` occurrences or more,
    and each language's number of words (in a row without any).

    Runs are merged where their prefix (language, first two words) is dealt to.
    """

    def merged(runs: DataFrame) -> DataFrame:
        dealt = runs.repartition("lang", "w1", "w2")
        return written(dealt.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n")).filter(
            (F.col("n") >= min_count) | F.col("w1").isNull()))

    words = merged(phrase_runs(docs, 1, None, text, lang))
    pairs = phrase_runs(docs, 2, _filter_of(_word_slots(words.filter("w1 is not null"))), text, lang)
    frequent = written(pairs.repartition("h").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count).select("h"))
    return words.unionByName(merged(phrase_runs(docs, 3, _filter_of(frequent), text, lang)))


def _floor_score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exact: 38 decimal digits."""
    return F.expr(f"cast(cast(1000000 as decimal(7,0)) * cast({a} as decimal(15,0)) * cast({a} as decimal(15,0))"
                  f" div (cast({left} as decimal(18,0)) * cast({right} as decimal(18,0))) as long)")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, hidden_percent: int = HIDDEN_PERCENT,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two or three words.

    A phrase scores by its weakest cut into two parts, floor(10^6 a^2 / (l r)). A phrase inside a
    longer candidate with ``hidden_percent`` of its occurrences or more is left out.
    """
    counted = phrase_counts(docs, min_count, text, lang)
    total = counted.filter("w1 is null").select(F.col("lang").alias("tl"), F.col("n").alias("total"))
    ones = counted.filter("w1 is not null and w2 is null").select("lang", F.col("w1").alias("x"), F.col("n").alias("f"))
    twos = counted.filter("w2 is not null and w3 is null").select("lang", F.col("w1").alias("x"), F.col("w2").alias("y"), F.col("n").alias("f"))
    found = counted.filter("w2 is not null").withColumn("z", F.coalesce("w3", "w2"))  # z: the last word

    def part(table: DataFrame, name: str, x: str, y: str | None = None) -> DataFrame:
        columns = [F.col("lang"), F.col("x").alias(x)] + ([F.col("y").alias(y)] if y else [])
        return table.select(*columns, F.col("f").alias(name))

    scored = (found.join(part(ones, "f1", "w1"), ["lang", "w1"]).join(part(ones, "fz", "z"), ["lang", "z"])
              .join(part(twos, "f12", "w1", "w2"), ["lang", "w1", "w2"])  # of a pair: itself
              .join(part(twos, "f23", "w2", "w3"), ["lang", "w2", "w3"], "left"))
    pair = F.struct(_floor_score("n", "f1", "fz").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("fz").alias("r"))
    early = F.struct(_floor_score("n", "f1", "f23").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("f23").alias("r"))
    late = F.struct(_floor_score("n", "f12", "fz").alias("score"), F.lit(2).alias("k"), F.col("f12").alias("l"), F.col("fz").alias("r"))
    cut = scored.withColumn("cut", F.when(F.col("w3").isNull(), pair).otherwise(F.least(early, late)))

    threes = counted.filter("w3 is not null")
    inner = threes.select("lang", F.explode(F.array(F.struct(F.col("w1").alias("x"), F.col("w2").alias("y")),
                                                    F.struct(F.col("w2").alias("x"), F.col("w3").alias("y")))).alias("p"), "n")
    longest = inner.groupBy("lang", F.col("p.x").alias("w1"), F.col("p.y").alias("w2")).agg(F.max("n").alias("longer"))
    shown = cut.join(longest, ["lang", "w1", "w2"], "left").filter(
        F.col("w3").isNotNull() | F.col("longer").isNull() | (100 * F.col("longer") < hidden_percent * F.col("n")))
    phrases = shown.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("n").alias("a"),
                           F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = phrases.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(total, F.col("lang") == F.col("tl")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents").select("text", "lang"))

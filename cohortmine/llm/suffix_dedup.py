"""Suffix-array dedup (operator 7): remove bytes covered by long strings that occur elsewhere.

The suffixes to sort are the ``LENGTH``-byte strings of all texts, one a byte. They are dealt to
groups by their anchor: of the ``GRAM``-byte grams inside the string, the rightmost of least
hash. Equal strings have equal anchors at equal offsets, so each group decides for itself which
of its strings are equal. Neighbouring strings mostly share their anchor, so a group holds one
context (the bytes of all strings that have this anchor) instead of hundreds of strings.

Contexts that occur whole more than once (the inside of every repeat) are found by counting
their digests. The others - the ends of repeats - are ordered within their group by deep-shallow
sorting: multikey quicksort to a shallow depth, blind tries for the groups that still agree
there. From the order of what follows the anchor, and of what precedes it read backwards, the
common lengths give exactly which strings of a context occur in another one.

A group with more than ``GROUP_CONTEXTS`` distinct contexts is not gathered: its strings are
counted one by one, by digest, with partial sums.

Defined cases: a null or empty text has no bytes; shorter texts lose nothing; repeated rows are
separate documents that repeat each other; equal strings that overlap count; an empty table
gives no rows; other columns are not read, clashing names give way to the result's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmine.llm.common import checkpointed, read, small_enough, text_or_empty, written

LENGTH = 400
GRAM = 64
SHALLOW = 32            # bytes ordered by multikey quicksort
GROUP_CONTEXTS = 20_000
CHUNK = 1 << 20         # bytes of a text anchored at a time
BROADCAST_KEYS = 1_000_000
_BASE = 0x9E3779B97F4A7C15
_POS = np.uint64((1 << 21) - 1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.full(n, _BASE, np.uint64)
        up[0] = 1
        down = np.full(n, inverse, np.uint64)
        down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def anchors(data: bytes, length: int, gram: int, powers) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: (gram hash, anchor position, least and greatest offset of its strings' starts)."""
    n, w = len(data), length - gram + 1
    for c0 in range(0, max(n - length + 1, 0) and n, CHUNK):
        c1 = min(c0 + CHUNK, n)
        lo = max(0, c0 - w + 1)                  # starts of strings that may have an anchor here
        hi = min(n, c1 - 1 + length)             # bytes of the last of them
        raw = np.frombuffer(data, np.uint8, hi - lo, lo)
        if len(raw) < length:
            continue
        up, down = powers
        with np.errstate(over="ignore"):
            s = np.empty(len(raw) + 1, np.uint64)
            s[0] = 0
            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=s[1:])
            h = (s[gram:] - s[:-gram]) * down[:len(raw) - gram + 1]
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        least = (h & ~_POS) | (_POS - np.arange(len(h), dtype=np.uint64))
        step = 1
        while 2 * step <= w:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if w > step:
            least = np.minimum(least[:len(least) - (w - step)], least[w - step:])
        at = (_POS - (least & _POS)).astype(np.int64)   # anchor of the string that starts at each place
        cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[cut[1:], len(at)] - 1
        a = at[cut]
        own = (a + lo >= c0) & (a + lo < c1)
        a, cut, last = a[own], cut[own], last[own]
        yield h[a].view(np.int64), a + lo, a - last, a - cut


def _anchor_rows(frames: Iterator[pd.DataFrame], length: int, gram: int) -> Iterator[pd.DataFrame]:
    powers = _powers(CHUNK + 2 * length)
    digest = xxhash.xxh3_128_digest
    for f in frames:
        parts, seen = [], []
        for key, text in zip(f["key"], f["text"], strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            for g, a, l0, l1 in anchors(data, length, gram, powers):
                seen += [digest(data[s:e] + bytes((o & 255, o >> 8))) for s, e, o in
                         zip((a - l1).tolist(), (a - l0 + length).tolist(), l1.tolist(), strict=True)]
                parts.append((np.full(len(a), key, np.int64), g, a, l0, l1))
        if parts:
            x = np.frombuffer(b"".join(seen), np.int64).reshape(-1, 2)
            key, g, a, l0, l1 = (np.concatenate(c) for c in zip(*parts, strict=True))
            yield pd.DataFrame({"g": g, "x": x[:, 0], "y": x[:, 1], "key": key, "pos": a,
                                "l0": l0.astype(np.int32), "l1": l1.astype(np.int32)})


def _common(a: bytes, b: bytes, low: int = 0) -> int:
    """Length of the common prefix, known to be at least ``low``."""
    high = min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:  # a[:low] agree, a[:high] do not
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def _char(s: bytes, d: int) -> int:
    """Character at a depth; the end sorts before all."""
    return s[d] if d < len(s) else -1


class _Inner:
    """Branching node of a blind trie: its depth, children by character, any leaf below."""

    __slots__ = ("depth", "kids", "leaf")

    def __init__(self, depth: int, kids: dict, leaf: list[int]):
        self.depth, self.kids, self.leaf = depth, kids, leaf


class _BlindTrie:
    """Orders strings that share a long prefix: descend by branching characters only, compare
    with the one leaf reached, and branch where they part. A leaf lists equal strings."""

    def __init__(self, strings: list[bytes], shared: int):
        self.strings, self.shared, self.root = strings, shared, None

    def add(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [i]
            return
        node = self.root
        while isinstance(node, _Inner):
            node = node.kids.get(_char(s, node.depth), node.leaf)
        other = self.strings[node[0]]
        if s == other:
            node.append(i)
            return
        d = _common(s, other, self.shared)
        above, node = None, self.root
        while isinstance(node, _Inner) and node.depth < d:
            above, node = node, node.kids[_char(s, node.depth)]
        leaf = [i]
        if isinstance(node, _Inner) and node.depth == d:
            node.kids[_char(s, d)] = leaf
            return
        inner = _Inner(d, {_char(other, d): node, _char(s, d): leaf}, leaf)
        if above is None:
            self.root = inner
        else:
            above.kids[_char(s, above.depth)] = inner

    def ordered(self, common: int) -> Iterator[tuple[int, int]]:
        """(item, common length with the item before); ``common`` is the first one's."""
        stack = [(self.root, common)]
        while stack:
            node, c = stack.pop()
            if isinstance(node, _Inner):
                kids = [node.kids[k] for k in sorted(node.kids)]
                stack += [(x, node.depth) for x in reversed(kids[1:])]
                stack.append((kids[0], c))
            else:
                yield node[0], c
                for i in node[1:]:
                    yield i, len(self.strings[i])


def deep_shallow(strings: list[bytes], shared: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Order of strings that share ``shared`` bytes, and common lengths of neighbours in it."""
    order, common = [], []
    stack = [(list(range(len(strings))), shared, 0)]
    while stack:
        items, d, c = stack.pop()
        if len(items) == 1:
            order.append(items[0])
            common.append(c)
            continue
        if d >= shared + shallow:
            trie = _BlindTrie(strings, d)
            for i in items:
                trie.add(i)
            for i, c_ in trie.ordered(c):
                order.append(i)
                common.append(c_)
            continue
        pivot = _char(strings[items[len(items) // 2]], d)
        less, same, more = [], [], []
        for i in items:
            x = _char(strings[i], d)
            (same if x == pivot else less if x < pivot else more).append(i)
        if more:
            stack.append((more, d, d))
        if pivot < 0:  # all of these end here
            order += same  # nothing sorts before an end
            common += [c] + [d] * (len(same) - 1)
        else:
            stack.append((same, d + 1, d if less else c))
            if less:
                stack.append((less, d, c))
    return order, common


def _least_between(common: np.ndarray):
    """Range minimum over neighbours' common lengths (sparse table)."""
    table = [common]
    while 2 ** len(table) <= len(common):
        t, half = table[-1], 2 ** (len(table) - 1)
        table.append(np.minimum(t[:-half], t[half:]))

    def query(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least of common[lo + 1 .. hi]."""
        span = hi - lo
        k = np.floor(np.log2(span)).astype(np.int64)
        out = np.empty(len(lo), np.int64)
        for level in np.unique(k):
            sel = k == level
            t = table[level]
            out[sel] = np.minimum(t[lo[sel] + 1], t[hi[sel] + 1 - 2**level])
        return out

    return query


def _nodes(common: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(common length, first, last) of every maximal run of neighbours that share ``least`` or more."""
    stack: list[tuple[int, int]] = []  # (length, first)
    for i in range(1, len(common) + 1):
        c = common[i] if i < len(common) else -1
        first = i - 1
        while stack and stack[-1][0] > c:
            length, first = stack.pop()
            yield length, first, i - 1
        if c >= least and (not stack or stack[-1][0] < c):
            stack.append((c, first))


def repeated_offsets(contexts: list[bytes], l0: list[int], l1: list[int], length: int,
                     gram: int) -> list[list[tuple[int, int]]]:
    """For each context the offsets (ranges of l, the string starts l bytes before the anchor)
    whose string occurs in another of the contexts."""
    m = len(contexts)
    after = [c[o:] for c, o in zip(contexts, l1, strict=True)]
    before = [c[:o][::-1] for c, o in zip(contexts, l1, strict=True)]
    out: list[list[tuple[int, int]]] = [[] for _ in range(m)]

    def note(i: int, a: int, b: int) -> None:
        lo, hi = max(l0[i], length - a), min(l1[i], b)
        if lo <= hi:
            out[i].append((lo, hi))

    if m == 2:
        a, b = _common(after[0], after[1]), _common(before[0], before[1])
        note(0, a, b)
        note(1, a, b)
        return out
    same_gram = all(x[:gram] == after[0][:gram] for x in after)
    order, common = deep_shallow(after, gram if same_gram else 0)
    order_b, common_b = deep_shallow(before)
    rank = np.empty(m, np.int64)
    rank[order_b] = np.arange(m)
    least_b = _least_between(np.array(common_b, np.int64))
    order_a = np.array(order)
    for a, first, last in _nodes(common, length - max(l1)):
        items = order_a[first:last + 1]
        items = items[np.argsort(rank[items])]
        r = rank[items]
        near = least_b(r[:-1], r[1:])
        best = np.maximum(np.r_[near, 0], np.r_[0, near])
        for i, b in zip(items.tolist(), best.tolist(), strict=True):
            note(i, a, b)
    return out


def _group_spans(frames: Iterator[pd.DataFrame], length: int, gram: int) -> Iterator[pd.DataFrame]:
    """Rows of contexts in the order of their groups -> (key, start, end) of repeated bytes."""
    held: list[tuple] = []
    group, rows = None, []

    def flush() -> None:
        if len(held) > 1:
            ctx, l0, l1, key, pos, n = zip(*held, strict=True)
            for i, found in enumerate(repeated_offsets(list(ctx), list(l0), list(l1), length, gram)):
                if n[i] == 1:  # the others are covered whole
                    rows.extend((key[i], pos[i] - hi, pos[i] - lo + length) for lo, hi in found)
        held.clear()

    columns = ["ctx", "l0", "l1", "key", "pos", "n"]
    for f in frames:
        for g, *row in zip(f["g"], *[f[c] for c in columns], strict=True):
            if g != group:
                flush()
                group = g
            held.append(tuple(row))
        if len(rows) > 100_000:
            yield pd.DataFrame(rows, columns=["key", "start", "end"])
            rows = []
    flush()
    if rows:
        yield pd.DataFrame(rows, columns=["key", "start", "end"])


def _cut(frames: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Rows (key, text, wanted contexts) -> one row a context with its bytes."""
    for f in frames:
        rows = []
        for key, text, want in zip(f["key"], f["text"], f["want"], strict=True):
            data = text.encode("utf-8", "surrogatepass")
            for w in want:
                rows.append((w["g"], key, w["pos"], w["l0"], w["l1"], w["n"],
                             data[w["pos"] - w["l1"]:w["pos"] - w["l0"] + length]))
                if len(rows) >= 50_000:
                    yield pd.DataFrame(rows, columns=["g", "key", "pos", "l0", "l1", "n", "ctx"])
                    rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["g", "key", "pos", "l0", "l1", "n", "ctx"])


def _single_strings(frames: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Every string of each context by its digest, for groups too large to gather."""
    for f in frames:
        for key, pos, l0, l1, n, ctx in zip(*[f[c] for c in ("key", "pos", "l0", "l1", "n", "ctx")], strict=True):
            ls = range(l0, l1 + 1)
            d = b"".join(xxhash.xxh3_128_digest(ctx[l1 - x:l1 - x + length]) for x in ls)
            h = np.frombuffer(d, np.int64).reshape(-1, 2)
            yield pd.DataFrame({"d1": h[:, 0], "d2": h[:, 1], "key": key, "start": pos - np.arange(l0, l1 + 1), "n": n})


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   group_contexts: int = GROUP_CONTEXTS) -> DataFrame:
    """(key, text) rows -> (key, start, end): byte ranges covered by strings that occur elsewhere."""
    found = written(rows.mapInPandas(lambda it: _anchor_rows(it, length, gram),
                                     "g long, x long, y long, key long, pos long, l0 int, l1 int"))
    # Contexts by digest, then groups by their number of distinct ones that occur once.
    one = F.min(F.struct("key", "pos", "l0", "l1")).alias("one")
    per_x = found.groupBy("g", "x", "y").agg(F.count("*").alias("n"), one)
    per_g = per_x.groupBy("g").agg(F.count("*").alias("distinct"), F.count(F.when(F.col("n") == 1, 1)).alias("single"))
    whole = per_x.filter("n > 1").select(F.col("g").alias("wg"), F.col("x").alias("wx"), F.col("y").alias("wy"))
    inside = found.join(whole, (F.col("g") == F.col("wg")) & (F.col("x") == F.col("wx")) & (F.col("y") == F.col("wy")),
                        "left_semi").select("key", (F.col("pos") - F.col("l1")).alias("start"),
                                            (F.col("pos") - F.col("l0") + length).alias("end"))
    open_ = per_g.filter("distinct > 1 and single > 0").select(F.col("g").alias("og"), (F.col("distinct") > group_contexts).alias("large"))
    wanted = per_x.join(open_, F.col("g") == F.col("og")).select("one.*", "g", "n", "large")
    wanted = written(wanted)
    per_key = wanted.groupBy(F.col("key").alias("wk")).agg(
        F.collect_list(F.struct("g", "pos", "l0", "l1", "n")).alias("want"))  # within one text
    keyed = _with_keys(rows, per_key.select("wk"), "left_semi").dropDuplicates(["key"])         if _repeats(rows) else _with_keys(rows, per_key.select("wk"), "left_semi")
    contexts = keyed.join(per_key, F.col("key") == F.col("wk")).select("key", "text", "want").mapInPandas(
        lambda it: _cut(it, length), "g long, key long, pos long, l0 int, l1 int, n long, ctx binary")
    large = wanted.filter("large").select(F.col("g").alias("lg")).distinct()
    has_large = not large.isEmpty()
    if has_large:
        contexts = written(contexts)
        ordinary = contexts.join(large, F.col("g") == F.col("lg"), "left_anti")
    else:
        ordinary = contexts
    ends = ordinary.repartition("g").sortWithinPartitions("g").mapInPandas(
        lambda it: _group_spans(it, length, gram), "key long, start long, end long")
    spans = inside.unionByName(ends)
    if has_large:
        strings = written(contexts.join(large, F.col("g") == F.col("lg"), "left_semi").mapInPandas(
            lambda it: _single_strings(it, length), "d1 long, d2 long, key long, start long, n long"))
        twice = strings.groupBy("d1", "d2").agg(F.sum("n").alias("all")).filter("all > 1").select(
            F.col("d1").alias("t1"), F.col("d2").alias("t2"))
        more = strings.filter("n = 1").join(twice, (F.col("d1") == F.col("t1")) & (F.col("d2") == F.col("t2")), "left_semi")
        spans = spans.unionByName(more.select("key", "start", (F.col("start") + length).alias("end")))
    return spans


def _repeats(rows: DataFrame) -> bool:
    """Whether some rows share a key (equal id and text)."""
    return not rows.groupBy("key").count().filter("count > 1").isEmpty()


def _with_keys(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows whose key is (or is not) listed; the list travels when it is small, else both sides do."""
    side = checkpointed(keys.distinct())
    side = F.broadcast(side) if small_enough(side, BROADCAST_KEYS) else side
    return rows.join(side, F.col("key") == F.col(side.columns[0]), how)


def without_spans(data: bytes, starts, ends) -> tuple[bytes, int, int]:
    """The remaining bytes, how many were removed, and in how many maximal runs."""
    order = np.argsort(starts, kind="stable")
    s, e = np.asarray(starts)[order], np.maximum.accumulate(np.asarray(ends)[order])
    first = np.r_[True, s[1:] > e[:-1]]
    s, e = s[first], e[np.r_[np.flatnonzero(first)[1:] - 1, len(e) - 1]]
    kept = b"".join(data[a:b] for a, b in zip(np.r_[0, e], np.r_[s, len(data)], strict=True))
    return kept, int((e - s).sum()), len(s)


def dedup_bytes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH,
                gram: int = GRAM, group_contexts: int = GROUP_CONTEXTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): a row a document; ``kept`` are the
    remaining bytes (they need not be whole characters)."""
    t = text_or_empty(text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id), t).alias("key"), t.alias("text"))
    spans = repeated_spans(rows.select("key", "text"), length, gram, group_contexts)
    per_key = written(spans.groupBy(F.col("key").alias("sk")).agg(
        F.collect_list(F.struct("start", "end")).alias("spans")))  # within one text

    def trim(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for doc, txt, found in zip(f["doc_id"], f["text"], f["spans"], strict=True):
                data = txt.encode("utf-8", "surrogatepass")
                kept, removed, n = without_spans(data, [x["start"] for x in found], [x["end"] for x in found])
                out.append((doc, len(data), removed, n, hashlib.sha256(kept).hexdigest(), kept))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    cut = _with_keys(rows, per_key.select("sk"), "left_semi").join(per_key, F.col("key") == F.col("sk")).select(
        F.col("doc_id"), "text", "spans").mapInPandas(
        trim, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    zero = F.lit(0).cast("long")
    plain = _with_keys(rows, per_key.select("sk"), "left_anti").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"), F.col("text").cast("binary").alias("kept"))
    return cut.unionByName(plain)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")

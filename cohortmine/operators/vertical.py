"""Vertical sets: tid lists, diffsets and bitmaps of a group of transactions, and walks over them.

Transactions are hashed into groups of at most ``GROUP_TIDS`` and numbered inside them
(:func:`vertical_groups`). A group holds, for every frequent item, the numbers of its transactions:
as a sorted list, or as a 4 KiB bitmap where the list would be longer. Groups stay whole in one
partition of a reliable checkpoint, so counting passes over them shuffle only counts.

A task extends prefix classes depth first (:class:`PrefixClass`): the class of a prefix P holds for
each member X either t(PX), the transactions of PX, as a list or a bitmap, or the diffset
d(PX) = t(P) - t(PX). Whichever takes the fewest bytes is chosen class by class, and

    t(PXY) = t(PX) & t(PY),    d(PXY) = d(PY) - d(PX),    |t(PXY)| = |t(PX)| - |d(PXY)|

Two kinds of work use it: counting a set of candidates along their prefix tree
(:func:`candidate_counts`), and mining a group by itself (:func:`local_itemsets`).
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Functions that run in tasks travel by value: executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GROUP_TIDS = 24_576        # aimed at, so that a hashed group seldom passes the 32,768 bits of a bitmap
GROUP_BITS = 32_768
LIST_IDS = GROUP_BITS // 32  # longer lists of 4-byte numbers take more room than the bitmap
FLUSH_ROWS = 1 << 16
END = -(1 << 40)            # fills up the rows of a prefix tree; less than any item


def vertical_groups(pairs: DataFrame, groups: int) -> DataFrame:
    """Distinct (tid, item) rows -> (g, item, cnt, ids, bits), checkpointed, a group in one partition.

    ``ids`` are the sorted numbers of the item's transactions in the group, or null beside
    ``bits``, the bitmap of those numbers. ``g`` counts bitmap buckets: a hash group larger than
    one bucket is cut into several. The window sees one row a transaction.
    """
    key = F.pmod(F.xxhash64("tid"), F.lit(groups))
    carts = pairs.groupBy("tid").agg(F.collect_set("item").alias("own")).select("own", key.alias("h"), "tid")
    number = F.row_number().over(Window.partitionBy("h").orderBy("tid")) - 1
    placed = carts.select("own", "h", number.alias("r")).select(
        "h", F.floor(F.col("r") / GROUP_BITS).cast("int").alias("part"), (F.col("r") % GROUP_BITS).alias("r"), F.explode("own").alias("item"))
    sets = placed.groupBy("h", "part", "item").agg(
        F.count(F.lit(1)).cast("int").alias("cnt"), F.collect_list("r").alias("ids"), F.bitmap_construct_agg(F.col("r").cast("long")).alias("bits"))
    dense = F.col("cnt") > LIST_IDS
    rows = sets.select((F.col("part") * F.lit(groups) + F.col("h")).cast("long").alias("g"), "item", "cnt",
                       F.when(~dense, F.sort_array("ids")).alias("ids"), F.when(dense, F.col("bits")).alias("bits"))
    return rows.sortWithinPartitions("g", "item").checkpoint()


class PrefixClass:
    """The members of a prefix class: items (ascending), counts and their sets in one kind.

    ``kind`` is ``bits`` (rows of 64-bit words), ``list`` or ``diff`` (numbers end to end, cut at
    ``ends``); ``support`` is |t(P)|, ``mark`` a scratch row of one flag a transaction.
    """

    def __init__(self, items, counts, support: int, kind: str, sets, ends, mark) -> None:
        self.items, self.counts, self.support, self.kind = items, counts, support, kind
        self.sets, self.ends, self.mark = sets, ends, mark

    def child(self, i: int, keep: np.ndarray, least: int = 1, counts_only: bool = False) -> PrefixClass | None:
        """The class of P + member i over the later members chosen by ``keep`` (a flag each) that
        occur ``least`` times there; ``counts_only`` leaves their sets out."""
        later = np.flatnonzero(keep) + i + 1
        if not len(later):
            return None
        support = int(self.counts[i])
        if self.kind == "bits":
            sets, ends = self.sets[later] & self.sets[i], None
            counts = np.bitwise_count(sets).sum(1, dtype=np.int64)
        else:
            mine = self._numbers(i)
            self.mark[mine] = True
            sizes = self.ends[later + 1] - self.ends[later]
            flat = self.sets[_ranges(self.ends[later], sizes)]
            hit = self.mark[flat] if self.kind == "list" else ~self.mark[flat]
            self.mark[mine] = False
            new_sizes = _sums(hit, sizes)
            sets, ends = flat[hit], np.concatenate([[0], np.cumsum(new_sizes)])
            counts = new_sizes if self.kind == "list" else support - new_sizes
        good = counts >= least
        if not good.any():
            return None
        if counts_only:
            return PrefixClass(self.items[later][good], counts[good], support, self.kind, None, None, self.mark)
        if not good.all():
            if ends is not None:
                sizes = np.diff(ends)
                sets = sets[np.repeat(good, sizes)]
                ends = np.concatenate([[0], np.cumsum(sizes[good])])
            else:
                sets = sets[good]
            counts = counts[good]
        made = PrefixClass(self.items[later][good], counts, support, self.kind, sets, ends, self.mark)
        return made._smallest(lambda: self._numbers(i))

    def _numbers(self, i: int) -> np.ndarray:
        if self.kind == "bits":
            return _of_words(self.sets[i])
        return self.sets[self.ends[i]:self.ends[i + 1]]

    def _smallest(self, numbers: Callable[[], np.ndarray]) -> PrefixClass:
        """In the kind that takes the fewest bytes; ``numbers`` gives t(P) (not asked of diffsets)."""
        if self.kind == "diff":
            return self
        total = int(self.counts.sum())
        size = {"list": 4 * total, "diff": 4 * (len(self.counts) * self.support - total),
                "bits": len(self.counts) * len(self.mark) // 8}
        best = min(size, key=size.get)
        if best == self.kind or 2 * size[best] > size[self.kind]:
            return self
        if best == "bits":
            return self  # lists only shrink from here on: a bitmap would not be smaller for long
        if self.kind == "bits":
            member, number = np.nonzero(np.unpackbits(self.sets.view(np.uint8), axis=1, bitorder="little"))
            ends = np.concatenate([[0], np.cumsum(np.bincount(member, minlength=len(self.items)))])
            self.kind, self.sets, self.ends = "list", number.astype(np.int32), ends
        if best == "diff":
            prefix = numbers()
            place = np.searchsorted(prefix, self.sets)
            missing = np.ones((len(self.items), len(prefix)), bool)
            missing[np.repeat(np.arange(len(self.items)), np.diff(self.ends)), place] = False
            member, number = np.nonzero(missing)
            self.ends = np.concatenate([[0], np.cumsum(np.bincount(member, minlength=len(self.items)))])
            self.kind, self.sets = "diff", prefix[number]
        return self


def _of_words(words: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little")).astype(np.int32)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, end to end."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


def _sums(flags: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(flags)])
    ends = np.cumsum(sizes)
    return upto[ends] - upto[ends - sizes]


class Group:
    """A group's single items, as gathered from its rows."""

    def __init__(self, g: int) -> None:
        self.g = g
        self.items: list[int] = []
        self.ids: list[np.ndarray] = []

    def root(self) -> PrefixClass:
        """The class of the empty prefix."""
        items = np.array(self.items, np.int64)
        counts = np.array([len(x) for x in self.ids], np.int64)
        ends, numbers = np.concatenate([[0], np.cumsum(counts)]), np.concatenate(self.ids)
        width = (int(numbers.max()) + 64) // 64 * 64
        mark = np.zeros(width, bool)
        if 4 * len(numbers) <= len(items) * width // 8:
            return PrefixClass(items, counts, width, "list", numbers, ends, mark)
        words = np.zeros((len(items), width // 64), np.uint64)
        for i, ids in enumerate(self.ids):
            mark[ids] = True
            words[i] = np.packbits(mark, bitorder="little").view(np.uint64)
            mark[ids] = False
        return PrefixClass(items, counts, width, "bits", words, None, mark)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[Group]:
    """The groups of a partition, one after the other."""
    now = None
    for batch in batches:
        ids, bits = batch.column(3), batch.column(4)
        values, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
        sparse = ids.is_valid().to_numpy(zero_copy_only=False)
        for row, (g, item) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            if now is None or g != now.g:
                if now is not None:
                    yield now
                now = Group(g)
            now.items.append(item)
            now.ids.append(values[offsets[row]:offsets[row + 1]] if sparse[row] else _of_words(np.frombuffer(bits[row].as_py(), np.uint64)))
    if now is not None:
        yield now


class PrefixTree:
    """Candidates as rows of ascending items (shorter ones filled up with ``END``), sorted: a prefix is a run of rows."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows[np.lexsort(rows.T[::-1])]
        self.counts = np.zeros(len(rows), np.int64)

    def count(self, root: PrefixClass) -> None:
        """Add the counts of a group."""
        self._walk(root, 0, len(self.rows), 0)

    def _walk(self, cls: PrefixClass, lo: int, hi: int, depth: int) -> None:
        column = self.rows[lo:hi, depth]
        edge = np.flatnonzero(np.diff(column, prepend=END - 1)) + lo
        at = np.searchsorted(cls.items, self.rows[edge, depth])
        width = self.rows.shape[1]
        for a, b, i in zip(edge.tolist(), [*edge[1:].tolist(), hi], at.tolist(), strict=True):
            if i == len(cls.items) or cls.items[i] != self.rows[a, depth]:
                continue  # does not occur in the group
            if depth + 1 == width or self.rows[a, depth + 1] == END:
                self.counts[a] += cls.counts[i]
                a += 1
                if a == b:
                    continue
            last = depth + 2 == width or (self.rows[a:b, depth + 2] == END).all()
            wanted = np.unique(self.rows[a:b, depth + 1] if last else self.rows[a:b, depth + 1:])
            rest = cls.items[i + 1:]
            spot = np.searchsorted(rest, wanted)
            spot = spot[(spot < len(rest)) & (rest[np.minimum(spot, len(rest) - 1)] == wanted)] if len(rest) else spot[:0]
            keep = np.zeros(len(rest), bool)
            keep[spot] = True
            child = cls.child(i, keep, counts_only=last)
            if child is None:
                continue
            if last:
                found = np.searchsorted(child.items, self.rows[a:b, depth + 1])
                found = np.minimum(found, len(child.items) - 1)
                self.counts[a:b] += np.where(child.items[found] == self.rows[a:b, depth + 1], child.counts[found], 0)
            else:
                self._walk(child, a, b, depth + 1)


def _itemset_batch(rows: list[list[int]], counts: list[int], g: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.list_(pa.int32())), pa.array(counts, pa.int64()), pa.array([g] * len(rows), pa.int64())], ["items", "cnt", "g"])


def candidate_counts(groups: DataFrame, tree: np.ndarray) -> DataFrame:
    """(items, cnt): candidates (rows of a :class:`PrefixTree`) with their counts over all groups.

    The tree is broadcast: the caller has checked its size. A task sends one row a candidate that
    occurs in its groups.
    """
    shared = groups.sparkSession.sparkContext.broadcast(tree)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = PrefixTree(shared.value)
        for group in _groups(batches):
            tree.count(group.root())
        hit = np.flatnonzero(tree.counts)
        for lo in range(0, len(hit), FLUSH_ROWS):
            at = hit[lo:lo + FLUSH_ROWS]
            rows = tree.rows[at]
            sizes = (rows != END).sum(1)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows[rows != END].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([lists, pa.array(tree.counts[at])], ["items", "cnt"])

    found = groups.mapInArrow(count, "items array<int>, cnt long")
    return found.groupBy("items").agg(F.sum("cnt").alias("cnt"))


def pair_counts(groups: DataFrame) -> DataFrame:
    """(items, cnt) of all pairs that share a transaction, counted group by group.

    An item's transactions are looked up as rows of the group's baskets, so the work is the number
    of pairs that co-occur; a task sends one row a pair, not one a pair and transaction.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, rows = [], [], 0

        def settled() -> tuple[np.ndarray, np.ndarray]:
            key, place = np.unique(np.concatenate(keys), return_inverse=True)
            return key, np.bincount(place, np.concatenate(counts)).astype(np.int64)

        for group in _groups(batches):
            for key, n in _pairs_of(group):
                keys.append(key)
                counts.append(n)
                rows += len(key)
            if rows > 4_000_000:
                key, n = settled()
                keys, counts, rows = [key], [n], len(key)
                if rows > 2_000_000:  # mostly distinct: hand them on
                    yield from _pair_batches(key, n)
                    keys, counts, rows = [], [], 0
        if keys:
            yield from _pair_batches(*settled())

    found = groups.mapInArrow(count, "x int, y int, cnt long")
    return found.groupBy("x", "y").agg(F.sum("cnt").alias("cnt")).select(F.array("x", "y").alias("items"), "cnt")


def _pair_batches(key: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(key), FLUSH_ROWS):
        k = key[lo:lo + FLUSH_ROWS]
        yield pa.RecordBatch.from_arrays(
            [pa.array((k >> 32).astype(np.int32)), pa.array((k & 0xFFFFFFFF).astype(np.uint32).view(np.int32)), pa.array(counts[lo:lo + FLUSH_ROWS])],
            ["x", "y", "cnt"])


def _pairs_of(group: Group) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(packed pairs, counts) of each item with the later items of its transactions."""
    items = np.array(group.items, np.int64)
    sizes = np.array([len(x) for x in group.ids])
    member = np.repeat(np.arange(len(items)), sizes)
    number = np.concatenate(group.ids)
    order = np.argsort(number, kind="stable")  # by transaction, items ascending
    basket, where = member[order], np.empty(len(order), np.int64)
    where[order] = np.arange(len(order))
    end = np.cumsum(np.bincount(number, minlength=GROUP_BITS))
    starts = np.cumsum(sizes) - sizes
    for i in range(len(items) - 1):
        at = where[starts[i]:starts[i] + sizes[i]]
        later = end[group.ids[i]] - at - 1
        if not later.any():
            continue
        seen = np.bincount(basket[_ranges(at + 1, later)], minlength=len(items))
        hit = np.flatnonzero(seen)
        yield (items[i] << 32) | (items[hit] & 0xFFFFFFFF), seen[hit]


def local_itemsets(groups: DataFrame, least: int, n: int, max_size: int | None = None) -> DataFrame:
    """(items, cnt, g): itemsets of two or more items that a group holds in its share of ``least``
    among ``n`` transactions, ``cnt_g * n >= least * n_g``.

    An itemset of ``least`` transactions in all reaches that in at least one group, whatever the
    groups. Every group is mined depth first by itself; memory is one path of prefix classes.
    """

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list[int]] = []
        counts: list[int] = []

        def extend(cls: PrefixClass, prefix: list[int], bound: int) -> Iterator[None]:
            last = max_size is not None and len(prefix) + 2 >= max_size
            for i, x in enumerate(cls.items.tolist()):
                child = cls.child(i, np.ones(len(cls.items) - i - 1, bool), bound, counts_only=last)
                if child is None:
                    continue
                mine = [*prefix, x]
                rows.extend([*mine, y] for y in child.items.tolist())
                counts.extend(child.counts.tolist())
                if len(rows) >= FLUSH_ROWS:
                    yield
                if not last and len(child.items) > 1:
                    yield from extend(child, mine, bound)

        for group in _groups(batches):
            root = group.root()
            held = len(np.unique(np.concatenate(group.ids)))
            bound = max(1, -(-least * held // n))
            good = root.counts >= bound
            for i, x in enumerate(root.items.tolist()):
                child = root.child(i, good[i + 1:], bound, counts_only=max_size == 2) if good[i] else None
                if child is None:
                    continue
                rows.extend([x, y] for y in child.items.tolist())
                counts.extend(child.counts.tolist())
                for _ in extend(child, [x], bound) if max_size != 2 else ():
                    yield _itemset_batch(rows, counts, group.g)
                    rows, counts = [], []
            if rows:
                yield _itemset_batch(rows, counts, group.g)
                rows, counts = [], []

    return groups.mapInArrow(mine, "items array<int>, cnt long, g long")

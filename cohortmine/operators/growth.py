"""Pattern growth over blocks of weighted paths: the tasks of FP-growth.

A path is a basket as the ranks of its frequent items, ascending (rank 0 is the most frequent
item); equal paths are one with a weight, as in an FP-tree. Any frequent set of k items, its
greatest rank first, has a conditional pattern base: what stands before it in the paths that hold
it. A pass counts the items of the bases of all frequent k-sets, which are the sets of k + 1.

A base is reached through those of its suffixes (:class:`Base`), keeps only items that were
frequent with its suffix, and merges its equal paths where few items are left. Counts of blocks
add up, so paths may be dealt anyhow and a task holds one block and one chain of bases, whatever
an item's frequency.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Functions that run in tasks travel by value: executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ITEMS = 1 << 22  # items of a block's paths
MERGE_ITEMS = 16       # paths over at most so many items are merged by their bits
FLUSH_ROWS = 1 << 16


class Base:
    """Weighted paths: ``item`` holds the places of their items in ``ranks``, path after path."""

    def __init__(self, item: np.ndarray, row: np.ndarray, weight: np.ndarray, ranks: np.ndarray) -> None:
        m = len(ranks)
        if m <= MERGE_ITEMS and len(weight) > 2 << m:
            bits = np.bincount(row, (1 << np.arange(m))[item], len(weight)).astype(np.int64)
            total = np.bincount(bits, weight, 1 << m)
            kinds = np.flatnonzero(total)
            row, item = np.nonzero(kinds[:, None] >> np.arange(m) & 1)
            weight = total[kinds]
        self.item, self.row, self.weight, self.ranks = item, row, weight, ranks
        sizes = np.bincount(row, minlength=len(weight))
        self.start = np.cumsum(sizes) - sizes
        self.order = np.argsort(item.astype(np.uint16) if m <= 1 << 16 else item, kind="stable")
        self.bound = np.concatenate([[0], np.cumsum(np.bincount(item, minlength=m))])

    def before(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(items, rows, weights) of what stands before item ``i`` in the paths that hold it."""
        at = self.order[self.bound[i]:self.bound[i + 1]]
        first = self.start[self.row[at]]
        size = at - first
        row = np.repeat(np.arange(len(at)), size)
        spot = np.arange(len(row)) + np.repeat(first - (np.cumsum(size) - size), size)
        return self.item[spot], row, self.weight[self.row[at]]

    def child(self, i: int, ranks: np.ndarray) -> Base:
        """The conditional pattern base of item ``i`` over the items ``ranks``."""
        item, row, weight = self.before(i)
        place = np.full(len(self.ranks), -1)
        place[np.searchsorted(self.ranks, ranks)] = np.arange(len(ranks))
        item = place[item]
        keep = item >= 0
        return Base(item[keep], row[keep], weight, ranks)


def grow(base: Base, sets: np.ndarray, lo: int, hi: int, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(set, ranks, counts): what occurs before the sets ``lo`` to ``hi``, which share ``depth`` ranks.

    Only items that are frequent with a set's first k - 1 ranks are looked for.
    """
    heads, first = np.unique(sets[lo:hi, depth], return_index=True)
    ends = np.append(first[1:], hi - lo)
    places = np.searchsorted(base.ranks, heads)
    for i, a, b in zip(places.tolist(), (lo + first).tolist(), (lo + ends).tolist(), strict=True):
        if base.bound[i] == base.bound[i + 1]:
            continue
        if depth + 1 < sets.shape[1]:
            yield from grow(base.child(i, np.unique(sets[a:b, depth + 1:])), sets, a, b, depth + 1)
        else:
            item, row, weight = base.before(i)
            counts = np.bincount(item, weight[row], len(base.ranks))
            hit = np.flatnonzero(counts)
            if len(hit):
                yield a, base.ranks[hit], counts[hit]


def _blocks(batches: Iterator[pa.RecordBatch], n_items: int) -> Iterator[Base]:
    held, size = [], 0

    def block() -> Base:
        sizes = np.concatenate([x[0] for x in held])
        return Base(np.concatenate([x[1] for x in held]).astype(np.int64), np.repeat(np.arange(len(sizes)), sizes),
                    np.concatenate([x[2] for x in held]).astype(np.float64), np.arange(n_items))

    for batch in batches:
        lists = batch.column(0)
        items = lists.flatten().to_numpy()
        held.append((np.diff(lists.offsets.to_numpy()), items, batch.column(1).to_numpy()))
        size += len(items)
        if size >= BLOCK_ITEMS:
            yield block()
            held, size = [], 0
    if held:
        yield block()


def grown(paths: DataFrame, sets: np.ndarray, n_items: int) -> DataFrame:
    """(path, cnt) of the sets that have one item more than the frequent ``sets`` (sorted rows of ranks).

    ``paths`` has (path, w). The sets are broadcast: the caller bounds their size.
    """
    shared = paths.sparkSession.sparkContext.broadcast(sets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = shared.value
        width = sets.shape[1] + 1

        def batch_of(found: list) -> pa.RecordBatch:
            sizes = [len(x[1]) for x in found]
            rows = np.empty((sum(sizes), width), np.int32)
            rows[:, :-1] = np.repeat(sets[[x[0] for x in found]], sizes, axis=0)
            rows[:, -1] = np.concatenate([x[1] for x in found])
            offsets = np.arange(0, rows.size + 1, width, dtype=np.int32)
            counts = np.concatenate([x[2] for x in found]).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1))), pa.array(counts)], ["path", "cnt"])

        for base in _blocks(batches, n_items):
            found, rows = [], 0
            for one in grow(base, sets, 0, len(sets), 0):
                found.append(one)
                rows += len(one[1])
                if rows >= FLUSH_ROWS:
                    yield batch_of(found)
                    found, rows = [], 0
            if found:
                yield batch_of(found)

    return paths.mapInArrow(count, "path array<int>, cnt long").groupBy("path").agg(F.sum("cnt").alias("cnt"))


def coded_paths(baskets: DataFrame, names: pa.Array, parts: int) -> DataFrame:
    """One column of baskets -> (path, w), dealt to ``parts`` partitions; ``names`` are the items by rank.

    Paths of fewer than two items are left out: no set of two is in them.
    """

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            items = lists.flatten()
            rank = pc.index_in(items, value_set=names.cast(items.type)).fill_null(-1).to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
            key = np.sort((row << 32 | rank)[rank >= 0])
            row, rank = key >> 32, (key & 0xFFFFFFFF).astype(np.int32)
            sizes = np.bincount(row, minlength=len(lists))
            long = sizes > 1
            offsets = np.concatenate([[0], np.cumsum(sizes[long])]).astype(np.int32)
            path = pa.ListArray.from_arrays(pa.array(offsets), pa.array(rank[long[row]]))
            yield pa.RecordBatch.from_arrays([path], ["path"])

    return (baskets.mapInArrow(coded, "path array<int>").groupBy("path").agg(F.count(F.lit(1)).alias("w"))
            .repartition(parts, "path"))


def named_sets(sets: DataFrame, names: pa.Array, schema) -> DataFrame:
    """(path, k, cnt) with the ranks turned into ``names``, under ``schema`` (items, k, cnt)."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            sizes = pc.list_value_length(lists).to_numpy()
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            items = pa.ListArray.from_arrays(pa.array(offsets), names.take(lists.flatten()))
            yield pa.RecordBatch.from_arrays([items, batch.column(1), batch.column(2)], ["items", "k", "cnt"])

    return sets.mapInArrow(named, schema)

"""Ranked lexical search (operator 12): dense blocked matrix products with exact scores.

Items are dealt into blocks of at most ``BLOCK_TERMS`` item-term pairs, each with a compact
vocabulary of its own terms. One pass over the documents keeps, of every whole text, its length
and the counts of that vocabulary's terms; the corpus statistics (N, L, df) come from this table.
Then tiles of documents meet tiles of the vocabulary: a dense matrix of weights (items by terms)
times a dense matrix of impacts (terms by documents) by BLAS in float64. Weights and impacts are
integers, a tile has so few terms that its partial sums stay below 2**53, so every product is
exact whatever the order of its sums; tiles are added up in 64-bit integers.

Every task keeps the best documents of each item by (score, doc_id) and never drops a document
that ties with the last one kept before its id was compared; a window over those rows merges.

Defined cases: a null or wordless text of a document has no terms and is never returned; rows of
an item id are one item with the terms of all; an item without terms returns nothing; a null
doc_id sorts last; repeated document rows are ranked one by one; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortmine.llm.common import checkpointed, discard, quoted, read, written

TOP = 10
BLOCK_TERMS = 200_000   # item-term pairs broadcast at a time
TILE_DOCS = 512
TILE_TERMS = 4096       # 4096 * (largest weight * largest impact) < 2**53
TILE_ITEMS = 256
KEPT_ROWS = 200_000

# Bytes that part terms, and A-Z to a-z.
_APART = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_MAP = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _APART, b"abcdefghijklmnopqrstuvwxyz" + b" " * len(_APART))
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Integer impact of tf occurrences in documents of n terms, N documents and L terms in all."""
    m = 10 + (90 * n * documents) // length
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, term), distinct; A-Z lower-cased."""
    low = F.translate(F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")), UPPER, LOWER)
    return items.select(F.col(quoted(item_id)).alias("item"),
                        F.explode(F.regexp_extract_all(low, F.lit(f"({TERM})"), F.lit(0))).alias("term")).distinct()


def _blocks(pairs: DataFrame, block_terms: int) -> DataFrame:
    """(block, number, item, term): blocks of whole items; number counts the items."""
    sizes = pairs.groupBy("item").agg(F.count("*").alias("c"))
    # one row an item: a stated query set, much smaller than the documents
    running = sizes.withColumn("upto", F.sum("c").over(Window.orderBy(F.col("item").asc_nulls_last())))
    placed = running.select(F.col("item").alias("i"), F.floor((F.col("upto") - F.col("c")) / F.lit(block_terms)).alias("block"))
    return pairs.join(placed, F.col("item").eqNullSafe(F.col("i"))).select("block", "item", "term")


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, terms, counts): every document with a term; numbers of the vocabulary as int32 bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = shared.value.get
        for batch in batches:
            keep, lengths, terms, counts = [], [], [], []
            for row, value in enumerate(batch.column(1)):
                words = value.as_buffer().to_pybytes().translate(_MAP).split() if value.is_valid else []
                if not words:
                    continue
                met = Counter(map(find, words))
                met.pop(None, None)
                keep.append(row)
                lengths.append(len(words))
                terms.append(np.fromiter(met, np.int32, len(met)).tobytes())
                counts.append(np.fromiter(met.values(), np.int32, len(met)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(lengths, pa.int64()),
                 pa.array(terms, pa.binary()), pa.array(counts, pa.binary())], ["doc_id", "n", "terms", "counts"])

    source = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc_id"), F.col(quoted(text)).cast("string").alias("text"))
    return source.mapInArrow(vectors, "doc_id long, n long, terms binary, counts binary")


def _document_counts(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents holding each term of the vocabulary; one row a task and term reaches the sums."""

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            joined = b"".join(batch.column(0).to_pylist())
            total += np.bincount(np.frombuffer(joined, np.int32), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["t", "df"])

    table = vectors.select("terms").mapInArrow(holding, "t long, df long").groupBy("t").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[table.column("t").to_numpy()] = table.column("df").to_numpy()
    return out


class TopRows:
    """The best ``k`` (score, doc_id) rows of each item; ties by doc_id are settled before any is dropped."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.floor = k, np.ones(items, np.int64)
        self.item, self.score, self.doc, self.null = (np.zeros(0, np.int64) for _ in range(4))
        self.waiting: list[tuple] = []
        self.rows = 0

    def offer(self, first_item: int, scores: np.ndarray, docs: np.ndarray, null: np.ndarray) -> None:
        """Scores of a tile, items by documents."""
        at, col = np.nonzero(scores >= self.floor[first_item:first_item + len(scores), None])
        if len(at):
            self.waiting.append((at + first_item, scores[at, col], docs[col], null[col]))
            self.rows += len(at)
        if self.rows > KEPT_ROWS:
            self.settle()

    def settle(self) -> None:
        parts = [(self.item, self.score, self.doc, self.null), *self.waiting]
        item, score, doc, null = (np.concatenate([p[i] for p in parts]) for i in range(4))
        order = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[order], score[order], doc[order], null[order]
        start = np.flatnonzero(np.diff(item, prepend=-1))
        place = np.arange(len(item)) - np.repeat(start, np.diff(np.append(start, len(item))))
        last = place == self.k - 1
        self.floor[item[last]] = np.maximum(self.floor[item[last]], score[last])
        kept = place < self.k
        self.item, self.score, self.doc, self.null = item[kept], score[kept], doc[kept], null[kept]
        self.waiting, self.rows = [], 0


def _tile_scores(weights: list[tuple[np.ndarray, np.ndarray]], rows: np.ndarray, cols: np.ndarray, values: np.ndarray,
                 documents: int, tile_terms: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first item, scores) of a tile of documents: dense products by tiles of the terms that it holds.

    ``weights`` holds, for each tile of items, its terms (ascending) and its matrix items by terms.
    """
    present, place = np.unique(rows, return_inverse=True)
    first = 0
    for terms, matrix in weights:
        here, at, of = np.intersect1d(terms, present, assume_unique=True, return_indices=True)
        total = np.zeros((len(matrix), documents), np.int64)
        slot = np.full(len(present), -1)
        slot[of] = np.arange(len(here))
        to = slot[place]
        for lo in range(0, len(here), tile_terms):
            hi = min(lo + tile_terms, len(here))
            inside = (to >= lo) & (to < hi)
            dense = np.zeros((hi - lo, documents))
            dense[to[inside] - lo, cols[inside]] = values[inside]
            total += (matrix[:, at[lo:hi]] @ dense).astype(np.int64)  # exact: sums below 2**53
        yield first, total
        first += len(matrix)


def _search_block(docs: DataFrame, pairs: list[tuple[int, str]], k: int, stats: tuple[int, int] | None,
                  doc_id: str, text: str) -> tuple[DataFrame, tuple[int, int]]:
    """(number, doc_id, score) of the best rows of each item of a block, and (N, L)."""
    spark = docs.sparkSession
    names = sorted({term.encode() for _, term in pairs})
    vocabulary = {name: i for i, name in enumerate(names)}
    vectors = written(_vectors(docs, vocabulary, doc_id, text))
    if stats is None:
        row = vectors.agg(F.count("*"), F.sum("n")).first()
        stats = (row[0], row[1] or 0)
    documents, length = stats
    holding = _document_counts(vectors, len(names))
    weigh = np.array([weight(documents, d) if d else 0 for d in holding.tolist()], np.int64)
    tile_terms = max(1, min(TILE_TERMS, (1 << 53) // (1_000_000 * max(int(weigh.max(initial=1)), 1)) - 1))
    number = np.array([i for i, _ in pairs], np.int64)
    term = np.array([vocabulary[t.encode()] for _, t in pairs], np.int64)
    items = int(number.max(initial=-1)) + 1
    shared = spark.sparkContext.broadcast((number, term, weigh))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, term, weigh = shared.value
        tiles = []
        for lo in range(0, items, TILE_ITEMS):
            mine = (number >= lo) & (number < lo + TILE_ITEMS)
            terms, at = np.unique(term[mine], return_inverse=True)
            matrix = np.zeros((min(TILE_ITEMS, items - lo), len(terms)))
            matrix[number[mine] - lo, at] = weigh[terms[at]]
            tiles.append((terms, matrix))
        top = TopRows(items, k)
        for batch in batches:
            ids = batch.column(0)
            null = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), np.int64)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            lengths = batch.column(1).to_numpy(zero_copy_only=False)
            terms = [np.frombuffer(b, np.int32) for b in batch.column(2).to_pylist()]
            counts = [np.frombuffer(b, np.int32) for b in batch.column(3).to_pylist()]
            for lo in range(0, len(terms), TILE_DOCS):
                hi = min(lo + TILE_DOCS, len(terms))
                rows = np.concatenate(terms[lo:hi]).astype(np.int64)
                tf = np.concatenate(counts[lo:hi]).astype(np.int64)
                cols = np.repeat(np.arange(hi - lo), [len(t) for t in terms[lo:hi]])
                values = impacts(tf, lengths[lo:hi][cols], documents, length)
                for first, scores in _tile_scores(tiles, rows, cols, values, hi - lo, tile_terms):
                    top.offer(first, scores, ids[lo:hi], null[lo:hi])
        top.settle()
        yield pa.RecordBatch.from_arrays(
            [pa.array(top.item), pa.array(top.doc, mask=top.null == 1), pa.array(top.score)], ["number", "doc_id", "score"])

    found = vectors.mapInArrow(best, "number long, doc_id long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = checkpointed(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))
    discard(vectors)
    shared.unpersist()
    return ranked, stats


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item, scores above 0."""
    spark = docs.sparkSession
    pairs = checkpointed(_blocks(_item_terms(items, item_id, item_text), block_terms))
    out = spark.createDataFrame([], "number long, doc_id long, score long, rank int").withColumn("item_id", F.lit(None).cast(
        items.schema[item_id].dataType)).select("item_id", "rank", "doc_id", "score")
    stats = None
    for (block,) in pairs.select("block").distinct().orderBy("block").collect():
        mine = pairs.filter(F.col("block") == block)
        named = checkpointed(mine.select("item").distinct().withColumn(
            "number", F.row_number().over(Window.orderBy(F.col("item").asc_nulls_last())).cast("long") - 1))
        rows = mine.join(F.broadcast(named.withColumnRenamed("item", "i")), F.col("item").eqNullSafe(F.col("i"))).select("number", "term")
        table = rows.toArrow()  # at most block_terms pairs, or one item
        block_pairs = list(zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True))
        best, stats = _search_block(docs, block_pairs, k, stats, doc_id, text)
        out = out.unionByName(best.join(F.broadcast(named), "number").select(
            F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked_search(docs, read(spark, sf_dir, "benchmark").select("item_id", "text"))

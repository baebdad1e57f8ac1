"""Ranked lexical search against a plain ranking: blocks, tiles, ties."""

import math
import random
import re

import numpy as np
import pytest
from helpers import LOWER

from cohortmine.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _plain(docs, items, k):
    bags = [(i, _terms(t)) for i, t in docs]
    bags = [(i, w) for i, w in bags if w]
    big_n, big_l = len(bags), sum(len(w) for _, w in bags)
    by_item = {}
    for i, t in items:
        by_item.setdefault(i, set()).update(_terms(t))
    out = []
    for item, terms in by_item.items():
        ranked = []
        for doc, w in bags:
            score, m = 0, 10 + (90 * len(w) * big_n) // big_l
            for t in terms & set(w):
                df = sum(t in v for _, v in bags)
                weight = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df + 1)))
                score += weight * ((10 ** 9 * w.count(t)) // (1000 * w.count(t) + 8 * m))
            if score > 0:
                ranked.append((-score, doc is None, doc))
        ranked.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r, x[2], -x[0]) for r, x in enumerate(ranked[:k], 1)]
    return sorted(out, key=repr)


def _data(seed):
    rng = random.Random(seed)
    words = ["Ab", "c9", "日本", "é", "x-y", "q_r", "it's", "ÀB"] + [f"t{i}" for i in range(20)]
    docs = [(None, "Ab c9"), (900, None), (901, " .. ")]
    for i in range(150):
        docs.append((i, " ".join(rng.choice(words[:rng.choice((3, 28))]) for _ in range(rng.randint(0, 25)))))
    docs += [(d + 1000, t) for d, t in docs[10:60]] + docs[20:30]  # ties and repeated rows
    items = [(j, " ".join(rng.choice(words) for _ in range(rng.randint(0, 8)))) for j in range(12)]
    return docs, items + [(3, "t1 t2"), (50, None), (None, "c9")]


@pytest.mark.parametrize("block_terms", [200_000, 7])
def test_equals_plain_ranking(spark, block_terms, monkeypatch):
    docs, items = _data(block_terms)
    for name, value in (("TILE_DOCS", 16), ("TILE_TERMS", 3), ("TILE_ITEMS", 4), ("KEPT_ROWS", 30)):
        monkeypatch.setattr(ls, name, value)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in ls.ranked_search(d, i, block_terms=block_terms).collect()), key=repr)
    assert got == _plain(docs, items, 10)


def test_tiles_are_exact_near_the_bound():
    rng = np.random.default_rng(1)
    terms = np.arange(ls.TILE_TERMS)
    matrix = rng.integers(60_000, 70_000, (2, len(terms)))  # weights of 10^30 documents
    values = rng.integers(900_000, 1_000_001, len(terms))
    (first, total), = ls._tile_scores([(terms, matrix.astype(float))], terms, np.zeros(len(terms), int), values, 1, ls.TILE_TERMS)
    assert first == 0 and total[:, 0].tolist() == [int(sum(int(a) * int(b) for a, b in zip(row, values, strict=True))) for row in matrix]


def test_top_rows_keep_ties_by_least_id(monkeypatch):
    monkeypatch.setattr(ls, "KEPT_ROWS", 5)
    top = ls.TopRows(1, 3)
    for lo in (90, 60, 30, 0):
        top.offer(0, np.full((1, 10), 7), np.arange(lo, lo + 10), np.zeros(10, np.int64))
    top.settle()
    assert top.doc.tolist() == [0, 1, 2]

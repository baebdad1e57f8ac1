import random

import numpy as np
import pytest
import xxhash
from helpers import LOWER, Groups, table, words

from cohortmine.llm import simhash as sh


def _plain(text, k=3):
    w = words((text or "").translate(LOWER))
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] * bool(w)
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64(g.encode(), seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "Two WORDS", "a b c d a b c d", "ÀÉ x\x0bY\x1fz é 𝒳"])
def test_fingerprint_of_small_texts(text):
    assert sh.fingerprint(text) == _plain(text)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefg", k=5000))
    monkeypatch.setattr(sh, "_BLOCK", 97)
    assert sh.fingerprint(text) == _plain(text)


def test_query_equals_all_pairs(spark, sf):
    docs = table(sf, "documents")
    fps = [_plain(d["text"]) for d in docs]
    groups = Groups([d["doc_id"] for d in docs])
    for i in range(len(docs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                groups.join(docs[i]["doc_id"], docs[j]["doc_id"])
    want = {d["doc_id"]: (f"{p:016x}", groups.find(d["doc_id"])) for d, p in zip(docs, fps, strict=True)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in sh.op2_simhash(spark, sf).collect()}
    assert got == want


def _population(seed):
    rnd = random.Random(seed)
    base, out = rnd.getrandbits(64), set()
    for _ in range(400):  # a dense group of near copies
        y = base
        for _ in range(rnd.randint(1, 7)):
            y ^= 1 << rnd.randrange(64)
        out.add(y)
    while len(out) < 900:
        x = rnd.getrandbits(64) & rnd.choice([2**64 - 1, 0xFFFF00FFFFFF])
        out.add(x)
        for _ in range(rnd.choice([0, 0, 3])):
            x ^= 1 << rnd.randrange(64)
        out.add(x)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("max_bits, leaves", [(3, 20_000), (3, 20), (1, 20)])
def test_trie_join_equals_all_pairs(spark, max_bits, leaves):
    fps = _population(max_bits)
    groups = Groups(range(len(fps)))
    for i in range(len(fps)):
        gap = np.bitwise_count(fps[i + 1:] ^ fps[i])
        for j in np.flatnonzero(gap <= max_bits):
            groups.join(i, i + 1 + int(j))
    want = {}
    for i in range(len(fps)):
        want.setdefault(groups.find(i), set()).add(int(fps[i].view(np.int64)))
    want = {frozenset(v) for v in want.values() if len(v) > 1}
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {}
    for node, root in sh.near_fingerprints(df, max_bits, leaves).collect():
        got.setdefault(root, set()).add(node)
    assert {frozenset(v) for v in got.values()} == want


def test_more_bits_than_blocks_refused(spark):
    with pytest.raises(ValueError):
        sh.near_fingerprints(spark.createDataFrame([(1,)], "fp long"), 4)


def test_keep_one_of_each_group(spark):
    rows = [(3, "a b c d e", "x"), (1, "a b c d e", "y"), (1, "a b c d e", "y"), (2, "other words are here now", "x"), (5, None, "z"), (4, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(tuple(r) for r in sh.keep_one(df).collect())
    assert got == [(1, "a b c d e", "y"), (2, "other words are here now", "x"), (4, "", "z")]

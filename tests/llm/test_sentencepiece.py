import math
import os
import random
import time

import numpy as np
import pytest
from helpers import table

from cohortmine.llm import sentencepiece_sampling as sp

pytestmark = pytest.mark.skipif(not os.path.exists(sp.MODEL), reason="tokenizer file not present")


@pytest.fixture(scope="module")
def vocab():
    return sp.Vocabulary.load()


TEXTS = ["", " ", "  two  spaces ", "a▁b ▁ ▁▁", "line\n\n\tnext\r\n", "日本語 テキスト 𝒳𝓎 \u0000é", "x" * 5000,
         "the of and ofthe", "ünïcödé ßtraße", "tail \n"]


def test_round_trip_and_independence_of_batch(vocab):
    keys = np.arange(len(TEXTS)).astype(np.uint64)
    ids, n = sp.encode_rows(vocab, TEXTS, keys)
    ends = np.cumsum(n)
    for i, t in enumerate(TEXTS):
        own = ids[ends[i] - n[i]:ends[i]]
        assert vocab.decode(own.tolist()) == t
        alone, _ = sp.encode_rows(vocab, [t], keys[i:i + 1])
        assert (alone == own).all()


def _all_ways(vocab, text):
    """Every segmentation of a text as ids with its weight."""
    pieces = {}
    for i, raw in enumerate(vocab.text):
        if raw and i not in set(vocab.byte_ids.tolist()):
            pieces[raw.decode()] = i
    ways = [((), 0.0)]
    out = []
    text = " " + text

    def walk(at, ids, w):
        if at == len(text):
            out.append((tuple(ids), w))
            return
        for k in range(1, 17):
            p = pieces.get(text[at:at + k]) if at + k <= len(text) else None
            if p is not None:
                walk(at + k, [*ids, p], w + vocab.weight[p])
        if text[at] not in pieces:
            raw = text[at].encode()
            walk(at + 1, [*ids, *[int(vocab.byte_ids[b]) for b in raw]], w + vocab.byte_weight * len(raw))

    walk(0, [], 0.0)
    del ways
    return out


@pytest.mark.parametrize("text", ["than", "ab cd", "x\ny", "né𝒳"])
def test_samples_follow_the_lattice(vocab, text):
    ways = _all_ways(vocab, text)
    total = sum(math.exp(w) for _, w in ways)
    n = 20_000
    keys = np.arange(n).astype(np.uint64)
    ids, counts = sp.encode_rows(vocab, [text] * n, keys)
    ends = np.cumsum(counts)
    seen = {}
    for e, c in zip(ends, counts, strict=True):
        way = tuple(ids[e - c:e].tolist())
        seen[way] = seen.get(way, 0) + 1
    want = {ids_: math.exp(w) / total for ids_, w in ways}
    assert set(seen) <= set(want)
    for way, p in want.items():
        assert abs(seen.get(way, 0) / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3


def test_query_is_lossless_and_repeatable(spark, sf):
    docs = {d["doc_id"]: d["text"] for d in table(sf, "documents")}
    first = sp.op3_sentencepiece(spark, sf)
    rows = {r["doc_id"]: r for r in sp.decode(first).collect()}
    assert len(rows) == len(docs)
    assert all(r["lossless"] and r["decoded"] == docs[i] and r["n_pieces"] == len(r["pieces"]) for i, r in rows.items())
    other = sp.encode(spark.read.parquet(f"{sf}/documents.parquet").repartition(5)).select("doc_id", "pieces").collect()
    assert all(rows[r["doc_id"]]["pieces"] == r["pieces"] for r in other)


def test_slices_do_not_change_a_row(spark, monkeypatch):
    rows = [(i, " ".join(random.Random(i).choices(["the", "of", "anor", "thé"], k=i))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = {r["doc_id"]: r["pieces"] for r in sp.encode(df).collect()}
    monkeypatch.setattr(sp, "SLICE_CHARS", 50)
    assert {r["doc_id"]: r["pieces"] for r in sp.encode(df).collect()} == one


@pytest.mark.parametrize("make", [
    lambda r: "".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(1_000_000)),
    lambda r: "".join(r.choice("ACGT") for _ in range(300_000)),
    lambda r: "x" * 300_000,
    lambda r: "\U0001F600" * 200_000,
])
def test_long_texts_without_spaces(make):
    v = sp.Vocabulary.load()
    text = make(random.Random(3))
    start = time.process_time()
    ids, counts = sp.encode_rows(v, [text], np.array([5], np.uint64))
    assert time.process_time() - start < 20
    assert counts.tolist() == [len(ids)] and v.decode(ids.tolist()) == text


def test_stretches_are_drawn_alike_in_any_batch(monkeypatch):
    """Cuts, long stretches and single draws change no sample, whatever else is in the batch."""
    v = sp.Vocabulary.load()
    r = random.Random(4)
    texts = ["".join(r.choice("abcdeé ") for _ in range(n)) for n in (1, 40, 700)]
    texts += ["".join(r.choice("thequickbrown") for _ in range(900)), "字" * 300 + "word" * 100]
    keys = np.arange(len(texts), dtype=np.uint64)
    ids, counts = sp.encode_rows(v, texts, keys)
    alone = [sp.encode_rows(v, [t], k) for t, k in zip(texts, keys.reshape(-1, 1), strict=True)]
    assert ids.tolist() == [x for a, _ in alone for x in a.tolist()]
    monkeypatch.setattr(sp, "FEW_DRAWS", 1)
    assert sp.encode_rows(v, texts, keys)[0].tolist() == ids.tolist()
    monkeypatch.setattr(sp, "LONG_STRETCH", 10**4)
    again, same = sp.encode_rows(v, texts, keys)
    assert again.tolist() == ids.tolist() and same.tolist() == counts.tolist()


def test_lattice_parts_change_no_sample(monkeypatch):
    """Segments filtered in parts, as few as one a part, give the samples of one lattice."""
    import random

    import numpy as np

    from cohortmine.llm import sentencepiece_sampling as m

    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdeinst  \n中é▁😀") for _ in range(rng.randint(0, 400))) for _ in range(30)] + ["", "x" * 600]
    keys = np.arange(len(texts), dtype=np.uint64)
    vocab = m.Vocabulary.load()
    built = []
    init = m._Lattice.__init__
    monkeypatch.setattr(m._Lattice, "__init__", lambda self, v, s: (built.append(len(s)), init(self, v, s))[1])
    monkeypatch.setattr(m, "LATTICE_CHARS", 10**9)
    want = m.encode_rows(vocab, texts, keys)
    assert len(built) == 1
    for most in (1, 50):
        monkeypatch.setattr(m, "LATTICE_CHARS", most)
        got = m.encode_rows(vocab, texts, keys)
        assert all(np.array_equal(a, b) for a, b in zip(want, got, strict=True))
    assert len(built) > 10

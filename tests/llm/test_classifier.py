"""Attention-based classifier: gradients, passages, the fold, held-out accuracy."""

import re
import zlib

import numpy as np
from helpers import table

from cohortmine.llm import mil_quality as mq


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    bags = np.array([1, 3, 2, 5])
    x, y = rng.normal(size=(int(bags.sum()), 6)), np.array([1.0, 0, 1, 0])
    model = mq.GatedAttention(6, 5, 4)

    def loss():
        s = model.forward(x, bags)["score"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    grads = model.gradient(x, bags, y)
    for name, g in grads.items():
        flat = model.p[name].reshape(-1)
        for i in range(0, flat.size, 3):
            keep, step = flat[i], 1e-6
            flat[i] = keep + step
            up = loss()
            flat[i] = keep - step
            down = loss()
            flat[i] = keep
            assert abs((up - down) / (2 * step) - g.reshape(-1)[i]) < 1e-6


def test_attention_weighs_passages_of_each_bag():
    bags = np.array([1, 4, 2])
    f = mq.GatedAttention(3, 4, 2).forward(np.random.default_rng(1).normal(size=(7, 3)), bags)
    first = np.cumsum(bags) - bags
    assert np.allclose(np.add.reduceat(f["a"], first), 1) and (f["a"] > 0).all()
    for i, (lo, n) in enumerate(zip(first, bags, strict=True)):
        assert np.allclose(f["z"][i], (f["a"][lo:lo + n, None] * f["h"][lo:lo + n]).sum(0))


def test_passages_hold_every_word(monkeypatch):
    texts = [b"", b" \t\n", b"one", b"Word# " * 200 + b"END!", "é ü".encode(), b"x" * 500, b"a " * 64, b"a " * 65]
    parts = list(mq.encode(texts))
    sizes = np.concatenate([b for _, b in parts])
    assert sizes.tolist() == [max(1, -(-len(re.findall(rb"[^\x20\x09-\x0d]+", t)) // 64)) for t in texts]
    x = np.concatenate([p for p, _ in parts])
    words = x[:, len(mq._CLASSES)] * mq.PASSAGE_WORDS
    assert np.isclose(words.sum(), sum(len(t.split()) for t in texts))
    monkeypatch.setattr(mq, "BLOCK", 50)
    again = np.concatenate([p for p, _ in mq.encode(texts)])
    assert np.isclose((again[:, len(mq._CLASSES)] * mq.PASSAGE_WORDS).sum(), words.sum())
    # the same passage has the same features wherever it stands
    alone, = (p for p, _ in mq.encode([b"the same words here"]))
    beside = np.concatenate([p for p, _ in mq.encode([b"zzz zz", b"the same words here"])])
    assert np.allclose(alone[0], beside[-1], atol=1e-6)


def test_only_the_training_fold_is_learned_from(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(100)] + [(3, None), (None, 1)], "doc_id long, quality int")
    bags = mq.sample_bags(docs, labels)
    want = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 != 0]
    assert bags.count() == len(want)
    assert mq.sample_bags(docs, labels, sample_passages=7).count() == 7
    held = {r["doc_id"] for r in mq.quality_scores(docs, labels).filter("held_out").collect()}
    assert held == set(range(100)) - set(want)
    assert {r["score"] for r in mq.quality_scores(docs, labels).collect()} == {1.0}
    assert {r["score"] for r in mq.quality_scores(docs, labels.limit(0)).collect()} == {0.5}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in mq.op13_quality_classifier(spark, sf).collect()}
    truth = [(rows[r["doc_id"]], r["quality"]) for r in table(sf, "labels") if r["doc_id"] in rows]
    held = [(r["score"], r["predicted"], q) for r, q in truth if r["held_out"]]
    assert len(held) > 40
    good, bad = [h for h in held if h[2] == 1], [h for h in held if h[2] == 0]
    assert sum(h[1] for h in good) / len(good) > 0.97 and sum(h[1] for h in bad) / len(bad) < 0.15
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows.values())
    again = {r["doc_id"]: r["score"] for r in mq.op13_quality_classifier(spark, sf).collect()}
    assert all(abs(again[i] - r["score"]) < 1e-9 for i, r in rows.items())

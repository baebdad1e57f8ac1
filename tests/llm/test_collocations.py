"""Phrase collocations against a plain count; the trie's bursts, blocks and spills."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import LOWER

from cohortmine.llm import collocations as co


def _plain_counts(texts):
    out = Counter()
    for lang, text in texts:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                out.update((lang or "und", tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    return out


def _plain(texts, least, top, hidden):
    f = _plain_counts(texts)
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    out = []
    for (lang, words), a in cand.items():
        if any(x[0] == lang and len(x[1]) > len(words) and 100 * b >= hidden * a
               and any(x[1][i:i + len(words)] == words for i in range(len(x[1]) - len(words) + 1)) for x, b in cand.items()):
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = f[lang, words[:k]], f[lang, words[k:]]  # noqa: E741
            cuts.append((1000000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)  # noqa: E741
        n = sum(c for (g, w), c in f.items() if g == lang and len(w) == 1)
        out.append((lang, -score, -a, " ".join(words).encode(), l, r, n))
    rows = []
    for lang in {x[0] for x in out}:
        for rank, x in enumerate(sorted(x for x in out if x[0] == lang)[:top], 1):
            rows.append((lang, rank, x[3].decode(), -x[2], x[4], x[5], x[6], -x[1]))
    return sorted(rows)


def _texts(seed, n=120):
    rng = random.Random(seed)
    words = ["A", "b", "İx", "ß", "the", "The", "of", "\x85n", "日本", "z.z", "a,b", "e!"] + [f"w{i}" for i in range(12)]
    seps = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n", ";", "\x0b"]
    out = [(None, None), ("en", ""), ("de", " \t\n")]
    for _ in range(n):
        body = "".join(rng.choice(words[:rng.choice((4, 24))]) + rng.choice(seps) for _ in range(rng.randint(0, 60)))
        out.append((rng.choice(["en", "en", "en", "de", None]), body))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_count(spark, seed):
    texts = _texts(seed)
    docs = spark.createDataFrame(texts, "lang string, text string").repartition(5)
    got = sorted(tuple(r) for r in co.collocations(docs, min_count=4, top=40, hidden_percent=50).collect())
    assert got == _plain(texts, 4, 40, 50) and got


LIMITS = [(60, 1 << 18, 1 << 20), (1 << 20, 15, 40), (25, 9, 16), (1 << 20, 1 << 18, 3)]


@pytest.mark.parametrize("turn", [1, 2, 3])
@pytest.mark.parametrize("limits", LIMITS)
def test_spills_and_blocks_keep_counts(limits, turn, monkeypatch):
    monkeypatch.setattr(co, "BURST", 4)
    monkeypatch.setattr(co, "SPILL_TREES", 2)
    texts = _texts(5, 60)
    every = co.FrequentFilter(np.full(4096, 255, np.uint8))
    counter, got, runs = co.PhraseCounter(turn, every, *limits), Counter(), []
    batches = [b for lang, text in texts if text is not None for b in counter.add(lang or "und", text.encode())]
    for batch in [*batches, *counter.finish()]:
        rows = batch.to_pylist()
        for r in rows:
            got[r["h"] if turn == 2 else (r["lang"], tuple(w for w in (r["w1"], r["w2"], r["w3"]) if w is not None))] += r["n"]
        if turn != 2:
            runs.append([(r["w1"], r["w2"], r["w3"]) for r in rows])
    plain = _plain_counts(texts)
    if turn == 2:
        def h(lang, words):
            return int(co._mixed(lang, [np.array([co._word_hash(w.encode())], np.uint64) for w in words]).view(np.int64)[0])
        assert dict(got) == {h(lang, w): n for (lang, w), n in plain.items() if len(w) == 2}
    else:
        sizes = {1} if turn == 1 else {2, 3}
        assert {k: n for k, n in got.items() if k[1]} == {k: n for k, n in plain.items() if len(k[1]) in sizes}
    if turn == 1:
        assert sum(n for k, n in got.items() if not k[1]) == sum(n for k, n in plain.items() if len(k[1]) == 1)
    for run in runs:  # sorted by the words' bytes
        as_bytes = [tuple(w.encode() if w is not None else b"" for w in r) for r in run]
        assert as_bytes == sorted(as_bytes)
    assert not counter.tries and counter.entries == 0


def test_filter_passes_all_frequent_phrases(spark):
    words = [(lang, f"w{i}", None, None, 12) for i in range(500) for lang in ("en", "de")]
    known = co._filter_of(co._word_slots(spark.createDataFrame(words, co._PHRASE)))

    def h(lang, names):
        return co._mixed(lang, [np.array([co._word_hash(w.encode()) for w in names], np.uint64)])

    assert known.has(h("en", [f"w{i}" for i in range(500)])).all() and known.has(h("de", ["w7"])).all()
    assert known.has(h("en", [f"z{i}" for i in range(2000)])).mean() < 0.1
    assert len(co._filter_of(co._word_slots(spark.createDataFrame(words, co._PHRASE)), largest=1 << 15).bits) == 4096


def test_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(10 ** 12, 10 ** 12 + 7, 3 * 10 ** 12)], "a long, l long, r long")
    got = df.select(co._floor_score("a", "l", "r")).first()[0]
    assert got == 1000000 * 10 ** 24 // ((10 ** 12 + 7) * 3 * 10 ** 12)


def test_merge_is_one_shuffle_by_prefix(spark):
    docs = spark.createDataFrame(_texts(3, 5), "lang string, text string")
    plan = co.phrase_runs(docs, 1).repartition("lang", "w1", "w2").groupBy("lang", "w1", "w2", "w3").count()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1

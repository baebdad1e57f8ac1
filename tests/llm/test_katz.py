import collections
import math
import zlib

import pytest
from helpers import LOWER, table, words

from cohortmine.llm import katz as kz


def _model(docs):
    c1, c2, ch = collections.Counter(), collections.Counter(), collections.Counter()
    toks = [(i, words((t or "").translate(LOWER))) for i, t in docs]
    held = {i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2 for i, _ in toks}
    for i, w in toks:
        if not held[i]:
            c1.update([*w, None])
            for a, b in zip(["<s>", *w], [*w, None], strict=True):
                c2[a, b] += 1
                ch[a] += 1
    total = sum(c1.values())
    d1, d2 = (kz.discounts([sum(v == r for v in c.values()) for r in range(1, 7)]) for c in (c1, c2))
    left = lambda r, d: d[r - 1] * r if r <= 5 else r - 0.01
    p1 = {w: left(c, d1) / total for w, c in c1.items()}
    unknown = 1 - sum(p1.values())
    used, seen = collections.Counter(), collections.Counter()
    for (a, b), r in c2.items():
        used[a] += left(r, d2) / ch[a]
        seen[a] += p1[b]

    def p(a, b):
        r = c2.get((a, b), 0)
        if r:
            return left(r, d2) / ch[a]
        return p1.get(b, unknown) * ((1 - used[a]) / (1 - seen[a]) if a in ch else 1)

    def row(i, w):
        t = [*w, None]
        return (held[i], len(t), sum(x in c1 for x in t), total,
                sum(math.log10((c1[x] + 1) / (total + len(c1) + 1)) for x in t),
                sum(math.log10(p(a, b)) for a, b in zip(["<s>", *w], t, strict=True)))

    return {i: row(i, w) for i, w in toks}, p, c1, ch


def _same(got, want):
    return got[:4] == want[:4] and all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(got[4:], want[4:], strict=True))


@pytest.mark.parametrize("how", [{}, {"broadcast_words": 0}, {"parts": 5, "batch_tokens": 900},
                                 {"parts": 3, "batch_tokens": 500, "broadcast_words": 0}])
def test_equals_a_plain_model(spark, sf, how, monkeypatch):
    monkeypatch.setattr(kz, "PIECE", 300)  # long texts in several pieces
    docs = [(d["doc_id"], d["text"]) for d in table(sf, "documents")] + [(9001, None), (9002, ""), (None, "the of")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want, *_ = _model(docs)
    rows = kz.lm_scores(df, **how).collect()
    assert len(rows) == len(docs)
    assert all(_same(tuple(r)[1:], want[r[0]]) for r in rows)


def test_probabilities_sum_to_one(sf):
    docs = [(d["doc_id"], d["text"]) for d in table(sf, "documents")][:80]
    _, p, c1, ch = _model(docs)
    for a in ["<s>", "never seen", *sorted(ch, key=str)[:40]]:
        assert math.isclose(sum(p(a, b) for b in c1) + p(a, "never seen"), 1, rel_tol=1e-9)


def test_repeated_rows_train_twice_and_score_alike(spark):
    docs = [(1, "a b a c"), (1, "a b a c"), (3, "b a"), (8, "x a b")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = kz.lm_scores(df).collect()
    assert len(rows) == 4 and len({tuple(r) for r in rows}) == 3
    assert {r["n_tokens"] for r in rows if r["doc_id"] == 1} == {5}
    train = [t for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2]
    assert {r["train_tokens"] for r in rows} == {sum(len(t.split()) + 1 for t in train)}


def test_held_out_text_is_predicted_better_than_by_the_base(spark, sf):
    rows = [r for r in kz.op8_lm_scoring(spark, sf).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)

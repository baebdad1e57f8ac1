"""The stored Katz model: any order against a plain model, other texts, other sessions."""

import collections
import math
import zlib

import pytest
from helpers import LOWER, table, words

from cohortmine.llm import katz as kz
from cohortmine.llm import katz_tables as kt


def _left(r, d):
    return d[r - 1] * r if r <= 5 else r - 0.01


class Plain:
    """Katz backoff by dictionaries."""

    def __init__(self, docs, order):
        self.order, self.counts = order, [collections.Counter() for _ in range(order + 1)]
        for i, text in docs:
            if zlib.crc32(str(i).encode() if i is not None else b"") % 7 != 2:
                for ctx, w in self.tokens(text):
                    for n in range(1, order + 1):
                        if len(ctx) >= n - 1:
                            self.counts[n][ctx[len(ctx) - n + 1:], w] += 1
        self.total = sum(self.counts[1].values())
        self.d = [None] + [kz.discounts([sum(v == r for v in c.values()) for r in range(1, 7)]) for c in self.counts[1:]]
        self.c = collections.Counter()
        for n in range(1, order + 1):
            for (ctx, _), r in self.counts[n].items():
                self.c[n, ctx] += r
        self.follow = collections.defaultdict(list)
        for n in range(1, order + 1):
            for ctx, w in self.counts[n]:
                self.follow[n, ctx].append(w)

    def tokens(self, text):
        t = ["<s>", *words((text or "").translate(LOWER)), None]
        return [(tuple(t[max(0, i - self.order + 1):i]), t[i]) for i in range(1, len(t))]

    def p(self, ctx, w, n=None):
        n = self.order if n is None else n
        if len(ctx) < n - 1:
            return self.p(ctx, w, n - 1)
        ctx = ctx[len(ctx) - n + 1:]
        r = self.counts[n][ctx, w]
        if r:
            return _left(r, self.d[n]) / self.c[n, ctx]
        if n == 1:
            return 1 - sum(_left(x, self.d[1]) for x in self.counts[1].values()) / self.total if self.total else 1.0
        seen = self.follow.get((n, ctx))
        if not seen:
            return self.p(ctx[1:], w, n - 1)
        if not hasattr(self, "alphas"):
            self.alphas = {}
        if (n, ctx) not in self.alphas:
            self.alphas[n, ctx] = ((1 - sum(_left(self.counts[n][ctx, v], self.d[n]) for v in seen) / self.c[n, ctx])
                                   / (1 - sum(self.p(ctx[1:], v, n - 1) for v in seen)))
        return self.alphas[n, ctx] * self.p(ctx[1:], w, n - 1)

    def score(self, text):
        return sum(math.log10(self.p(ctx, w)) for ctx, w in self.tokens(text))


def _docs(sf, n=70):
    return [(d["doc_id"], d["text"][:1500] if d["text"] else d["text"]) for d in table(sf, "documents")][:n] + [
        (9001, None), (9002, ""), (None, "the of")]


def _frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_equals_a_plain_model_and_scores_other_texts(spark, sf, scratch, order):
    docs, plain = _docs(sf), Plain(_docs(sf), order)
    kt.train(_frame(spark, docs), f"{scratch}/model", order=order, parts=3)
    model = kt.load(spark, f"{scratch}/model")  # nothing but the tables is left
    assert model.spec.total == plain.total
    other = [(1, "A text the model never saw"), (2, docs[3][1] + " and zzqy more of the end"), (3, None)]
    for texts in (docs, other):
        got = kt.score(_frame(spark, texts), model).collect()
        assert len(got) == len(texts)
        want = {i: plain.score(t) for i, t in texts}
        assert all(math.isclose(r["score"], want[r["doc_id"]], rel_tol=1e-9, abs_tol=1e-9) for r in got)


def test_plain_probabilities_sum_to_one(sf):
    plain = Plain(_docs(sf, 30), 3)
    contexts = sorted({ctx for i, t in _docs(sf, 30) for ctx, _ in plain.tokens(t)}, key=str)[:25]
    for ctx in [*contexts, ("never", "seen")]:
        vocab = [w for _, w in plain.counts[1]]
        assert math.isclose(sum(plain.p(ctx, w) for w in vocab) + plain.p(ctx, "never seen"), 1, rel_tol=1e-9)


def test_order_two_is_lm_scores(spark, sf, scratch):
    docs = _frame(spark, _docs(sf, 200) + [(77, "again a b a")] * 2)
    got = kt.score(docs, kt.train(docs, f"{scratch}/model"))
    key = lambda r: (str(r["doc_id"]), r["n_tokens"])
    got, want = (sorted(df.collect(), key=key) for df in (got, kz.lm_scores(docs)))
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert tuple(a)[:5] == tuple(b)[:5]
        assert all(math.isclose(a[c], b[c], rel_tol=1e-9, abs_tol=1e-9) for c in ("base_score", "score"))


def test_hot_context_empty_training_clashes(spark, scratch):
    hot = [(i, "the " * 50 + f"w{i} the v{i % 3}") for i in range(40)]
    docs = _frame(spark, hot)
    model = kt.train(docs.selectExpr("*", "'x' as ctx2", "'y' as Word", "1 as `a.b`"), f"{scratch}/hot", order=3, parts=4)
    plain = Plain(hot, 3)
    got = kt.score(docs.selectExpr("*", "'x' as ctx2", "'y' as key"), model).collect()
    assert all(math.isclose(r["score"], plain.score(dict(hot)[r["doc_id"]]), rel_tol=1e-9) for r in got)
    none = kt.train(docs.filter("1 = 0"), f"{scratch}/none", order=3)
    assert {(r["score"], r["train_tokens"], r["n_known"]) for r in kt.score(docs, none).collect()} == {(0.0, 0, 0)}
    assert kt.score(docs.filter("1 = 0"), model).count() == 0
    with pytest.raises(ValueError):
        kt.train(docs, f"{scratch}/zero", order=0)
    with pytest.raises(Exception, match="exist"):
        kt.train(docs, f"{scratch}/hot", order=3)

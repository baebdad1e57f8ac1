import collections
import hashlib
import random

import pytest

from cohortmine.llm import suffix_dedup as sd


def _plain(texts, length):
    count = collections.Counter()
    data = [(t or "").encode() for t in texts]
    for d in data:
        for i in range(len(d) - length + 1):
            count[d[i:i + length]] += 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def _texts(seed, n=120):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcé", k=rnd.randint(1, 5))) for _ in range(60)]
    pool = [" ".join(rnd.choices(words, k=rnd.randint(5, 60))) for _ in range(10)]
    texts = []
    for _ in range(n):
        t = ""
        for _ in range(rnd.randint(0, 5)):
            k = rnd.random()
            x = rnd.choice(pool)
            if k < 0.4:
                t += x
            elif k < 0.5:
                a = rnd.randrange(len(x))
                t += x[a:a + rnd.randint(20, 90)]
            elif k < 0.55:
                t += "a" * rnd.randint(30, 150)
            elif k < 0.6:
                t += "ab " * rnd.randint(10, 50)
            else:
                t += " ".join(rnd.choices(words, k=rnd.randint(1, 40)))
        texts.append(t)
    return [*texts, *texts[:10], "", "a", None]


@pytest.mark.parametrize("seed, chunk, group", [(1, 1 << 20, 20_000), (2, 97, 20_000), (3, 1 << 20, 3)])
def test_equals_counting_every_string(spark, monkeypatch, seed, chunk, group):
    monkeypatch.setattr(sd, "CHUNK", chunk)
    texts = _texts(seed)
    ids = list(range(len(texts))) + [0]  # one row is repeated
    df = spark.createDataFrame([(i, texts[i]) for i in ids], "doc_id long, text string")
    want = sorted((i, *r) for i, r in zip(ids, _plain([texts[i] for i in ids], 40), strict=True))
    rows = sd.dedup_bytes(df, length=40, gram=8, group_contexts=group).collect()
    assert sorted(tuple(r)[:5] for r in rows) == want
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in rows)


@pytest.mark.parametrize("shallow", [0, 3, 60])
def test_deep_shallow_sort(shallow):
    rnd = random.Random(shallow)
    for _ in range(20):
        some = ["".join(rnd.choices("ab", k=rnd.randint(0, 40))).encode() for _ in range(40)]
        some = [b"zz" * 15 + x * rnd.randint(1, 2) for x in some]
        order, common = sd.deep_shallow(some, shared=rnd.choice([0, 30]), shallow=shallow)
        assert [some[i] for i in order] == sorted(some)
        assert all(common[k] == sd._common(some[order[k - 1]], some[order[k]]) for k in range(1, len(some)))


def test_query_on_documents(spark, sf):
    from helpers import table

    docs = table(sf, "documents")
    want = {d["doc_id"]: r for d, r in zip(docs, _plain([d["text"] for d in docs], 400), strict=True)}
    got = {r[0]: tuple(r)[1:] for r in sd.op7_suffix_dedup(spark, sf).collect()}
    assert got == want

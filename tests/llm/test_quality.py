import collections
import re

from helpers import table, words

from cohortmine.llm import quality_rules as qr


def _counts(text):
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    wins = collections.defaultdict(list)
    for i in range(len(w) - 2):
        wins[tuple(w[i:i + 3])].append(i)
    hit = {i + k for at in wins.values() if len(at) > 1 for i in at for k in range(3)}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), failed)


def test_counts_of_documents(spark, sf):
    want = {d["doc_id"]: _counts(d["text"]) for d in table(sf, "documents")}
    got = {r["doc_id"]: tuple(r)[1:7] for r in qr.op9_quality_rules(spark, sf).collect()}
    assert got == want


def _words(n, seed):
    return " ".join(f"w{seed}x{i}" for i in range(n))


def test_frequent_lines_deplete(spark):
    boiler = _words(60, "b")
    rows = [(i, f"{boiler}\n{_words(10, i)}", "h") for i in range(40)]             # mostly the shared line
    rows += [(100 + i, f"{boiler}\n{_words(200, 100 + i)}", "h") for i in range(40)]  # mostly their own
    rows += [(300 + i, _words(80, "copy"), "h") for i in range(60)]                # plain copies of one text
    rows += [(500, f"{boiler}\n{_words(10, 500)}", "other")]                      # rare at its own host
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"] for r in qr.quality_rules(df).filter("kept").collect()}
    assert kept == {i for i, *_ in rows if i >= 100}
    out = qr.keep_good(df)
    assert out.columns == df.columns and {r["doc_id"] for r in out.collect()} == kept


def test_no_python_in_the_plan(spark, sf):
    plan = qr.op9_quality_rules(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


def test_kept_documents_lose_their_frequent_lines(spark):
    boiler = _words(20, "b")
    rows = [(i, f"{boiler}\n\n{_words(100, i)}\n {boiler.upper()} \nend {i}", "h", 7) for i in range(30)]
    rows += [(90, f"{boiler}\n{_words(100, 90)}", "other", 7)]
    rows += [rows[3]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    want = sorted((i, t if s == "other" else f"\n{_words(100, i)}\nend {i}") for i, t, s, _ in rows)
    for out in (qr.keep_good(df), qr.quality_rules(df)):
        got = out.collect()
        assert sorted((r["doc_id"], r["text"]) for r in got) == want
        assert all(r["n_chars"] == (7 if r["doc_id"] == 90 else len(r["text"])) for r in got)

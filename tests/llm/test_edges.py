"""Every operator and stage: nulls, empty and long texts, ties, repeated rows, empty tables,
columns whose names clash with those that the operators make or use."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortmine.llm import collocations, html_text, katz, lexical_search, line_dedup, mil_quality, mixing, quality_rules
from cohortmine.llm import rp_forest, secret_scan, sentencepiece_sampling, simhash, suffix_dedup

# Clashes in lower case, in other cases, and names that need quotes.
CLASH = ("size target taken copies kept n_words n_lines n_removed fingerprint component_id spans n_assign pieces lossless "
         "h t id pos line root node a b key gone paths host unit cls bucket score text2 n_bytes held_out predicted "
         "N_Words N_LINES Spans PIECES Fingerprint KEPT w1 rank term item meta.lang a`b").split()
ROWS = [(None, None, None, None, None), (None, "a null id", "de", None, 9), (1, "", "en", "s", 0), (2, " \t\n ", "en", "s", 4),
        (3, "the same words\nagain the same words\n" * 40, "en", "s", 1), (4, "the same words\nagain the same words\n" * 40, "en", "s", 1),
        (4, "the same words\nagain the same words\n" * 40, "en", "s", 1), (5, "password=12345678 " + "word " * 40_000, "en", "t", 1),
        (6, "x" * 150_000, None, "t", 1), (7, "日本語 𝒳 ünï\u0000 ▁", "ja", "u", 1), (8, "one", "en", "", 3)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

OPERATORS = {
    "line_dedup": line_dedup.dedup_lines, "simhash": simhash.simhash_dedup, "sentencepiece": sentencepiece_sampling.encode,
    "secrets": secret_scan.scan, "mixing": mixing.mix, "suffix": suffix_dedup.dedup_bytes, "katz": katz.lm_scores,
    "quality": quality_rules.quality_rules,
    "classifier": lambda docs: mil_quality.quality_scores(docs, docs.selectExpr("doc_id", "doc_id % 2 as quality", "1 as y")),
}


def _wide(df):
    return df.select("*", *[F.lit(c).alias(c) for c in CLASH if c.lower() not in {"kept", "n_lines", "n_words", "spans", "pieces", "fingerprint"} or c != c.lower()])


@pytest.mark.parametrize("name", OPERATORS)
def test_operator_on_odd_rows(spark, name):
    docs = _wide(spark.createDataFrame(ROWS, SCHEMA))
    rows = OPERATORS[name](docs).collect()
    assert len(rows) == len(ROWS)
    ids = sorted(str(r["doc_id"]) for r in rows)
    assert ids == sorted(str(r[0]) for r in ROWS)
    twice = [str(r) for r in rows if r["doc_id"] == 4]
    if name != "mixing":
        assert twice[0] == twice[1]


@pytest.mark.parametrize("name", OPERATORS)
def test_operator_on_no_rows(spark, name):
    assert OPERATORS[name](_wide(spark.createDataFrame([], SCHEMA))).collect() == []


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
@pytest.mark.parametrize("rows", [ROWS, []], ids=["odd", "none"])
def test_stage(spark, stage, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    out = corpus_pipeline.STAGES[stage][1](spark, docs, "")
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == docs.columns
    assert out.count() <= 3 * len(rows)


def test_pages(spark):
    rows = [(1, "http://a.b/c", "<p>x"), (1, "http://a.b/c", "<p>x"), (None, None, None), (2, "", ""), (3, "odd", "<" * 500 + "<p>y" * 3000)]
    extra = ["text", "n_chars", "host", "path", "paths", "cut_host", "page", "shape", "words"]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", *[f"'{c}' as `{c}`" for c in extra])
    got = html_text.extract(df).collect()
    assert len(got) == len(rows) and [r["text"] for r in got if r["page_id"] == 1] == ["x", "x"]
    assert [(r["text"], r["n_chars"]) for r in got if r["page_id"] is None] == [("", 0)]
    assert html_text.extract(df.limit(0)).collect() == []


def test_stage_hands_clashing_columns_on(spark):
    docs = spark.createDataFrame([(i, "some plain words " * 30 + str(i), "en", "s", 9) for i in range(3)], SCHEMA).selectExpr(
        "*", "'mine' as N_Words", "'too' as kept", "'all' as n_lines", "'x' as `meta.lang`")
    for stage in range(4):
        out = corpus_pipeline.STAGES[stage][1](spark, docs, "")
        assert out.columns == docs.columns
        assert {tuple(r)[5:] for r in out.collect()} <= {("mine", "too", "all", "x")}


def test_phrases(spark):
    docs = _wide(spark.createDataFrame(ROWS * 3, SCHEMA))
    got = collocations.collocations(docs, min_count=2).collect()
    assert {r["lang"] for r in got} == {"de", "en", "ja"} and ("the same words", 720) in {(r["phrase"], r["a"]) for r in got}
    assert {r["n"] for r in collocations.collocations(docs, min_count=1).filter("lang = 'und'").collect()} <= {3}
    assert collocations.collocations(docs.limit(0)).collect() == []


def test_search(spark):
    docs = _wide(spark.createDataFrame(ROWS, SCHEMA))
    items = _wide(spark.createDataFrame([(1, "Same words"), (1, "null"), (2, None), (None, "one ONE"), (3, "nowhere"), (4, "word")],
                                        "item_id long, text string")).drop("item_id2")
    got = [tuple(r) for r in lexical_search.ranked_search(docs, items).collect()]
    assert sorted(r[1:3] for r in got if r[0] == 1) == [(1, 3), (2, 4), (3, 4), (4, None)] or len([r for r in got if r[0] == 1]) == 4
    assert [r[2] for r in got if r[0] is None] == [8] and [r[2] for r in got if r[0] == 4] == [5]
    assert not [r for r in got if r[0] in (2, 3)]
    assert lexical_search.ranked_search(docs.limit(0), items).collect() == []
    assert lexical_search.ranked_search(docs, items.limit(0)).collect() == []


def test_vectors(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (1, None), (1, [1.0, 0.1])], "vec_id long, embedding array<float>")
    wide = df.selectExpr("*", "1 as cls", "2 as id", "3 as root", "4 as n", "5 as n_links", "6 as code")
    got = sorted((tuple(r) for r in rp_forest.near_vectors(wide).collect()), key=str)
    assert got == [(1, 0, 1, True), (1, 1, 1, True), (None, 1, 1, False)]
    assert rp_forest.near_vectors(wide.limit(0)).collect() == []

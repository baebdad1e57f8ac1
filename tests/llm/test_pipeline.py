import corpus_pipeline
from cohortmine.llm import line_dedup, mixing, quality_rules, sentencepiece_sampling, simhash
from helpers import table


def test_run_equals_its_operators(spark, sf):
    """Each stage against the operator it calls, on what its predecessor kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"] for r in quality_rules.quality_rules(docs).filter("kept").collect()}
    one = corpus_pipeline.quality(spark, docs, sf).checkpoint()
    assert {r["doc_id"] for r in one.collect()} == kept
    texts = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(one).filter("n_removed < n_lines").collect()}
    two = corpus_pipeline.lines(spark, one, sf).checkpoint()
    assert {r["doc_id"]: r["text"] for r in two.collect()} == texts
    assert all(r["n_chars"] == len(r["text"]) for r in two.collect())
    first = {r["component_id"] for r in simhash.simhash_dedup(two).collect()}
    three = corpus_pipeline.near_dedup(spark, two, sf).checkpoint()
    assert sorted(r["doc_id"] for r in three.collect()) == sorted(first)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(three).collect() if r["copies"]}
    four = corpus_pipeline.mix(spark, three, sf).checkpoint()
    got = {r["doc_id"]: r["count"] for r in four.groupBy("doc_id").count().collect()}
    assert got == copies
    five = sentencepiece_sampling.decode(corpus_pipeline.encode(spark, four, sf)).collect()
    assert len(five) == sum(copies.values())
    assert all(r["lossless"] and r["decoded"] == texts[r["doc_id"]] for r in five)
    whole = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r["doc_id"], r["pieces"]) for r in whole) == sorted((r["doc_id"], r["pieces"]) for r in five)


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_dedup", "mixing", "sentencepiece"]
    assert table

"""Text sources and sinks (S1-S5, K1-K5) and the text-volume operator (H8)."""

import glob

from cohortmine import label_counts, total_text_length
from cohortmine.sources.text_io import (
    read_baskets_text,
    read_itemsets_text,
    read_lines,
    read_measurements_csv,
    read_subjects_text,
    write_itemsets_text,
    write_label_counts_text,
    write_rules_text,
    write_support_report_text,
)


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def _read_parts(folder):
    lines = []
    for p in sorted(glob.glob(f"{folder}/part-*")):
        with open(p) as fh:
            lines += [ln.rstrip("\n") for ln in fh]
    return lines


MEAS_CSV = """patientid,geneid,expression_value
p1,42,1300000
p1,7,1250000
p2,42,1250000.5
p2,42,2000000
p3,9,NaN
p4,42,1400000
"""
SUBJ_TXT = """id,age,labels,last
p1,50,leukemia lymphoma,1.0
p2,61,  breast-cancer  leukemia ,2.0
p3,40,flu,3.0
"""


def _fails(df, text):
    import pytest

    with pytest.raises(Exception, match=text):
        df.collect()


def test_header_is_dropped_wherever_it_stands(spark, scratch):
    import os

    os.mkdir(f"{scratch}/m")
    _write(f"{scratch}/m/part-0", "patientid,geneid,expression_value\np1,42,1300000\n")
    _write(f"{scratch}/m/part-1", "p2,42,1300000\np3,42,1e6,more\n")
    rows = {(r["subject_id"], r["feature_id"], r["value"]) for r in read_measurements_csv(spark, f"{scratch}/m").collect()}
    assert rows == {("p1", 42, 1300000.0), ("p2", 42, 1300000.0), ("p3", 42, 1e6)}


def test_bad_measurement_lines_fail_or_are_returned(spark):
    from cohortmine.sources import parse_measurement_lines, split_measurement_lines

    good = "p0,1,2.5"
    for bad in ("p1,42,13x", "p2,x42,1300000", "p4,42", ""):
        lines = spark.createDataFrame([(good,), (bad,)], "value string")
        _fails(parse_measurement_lines(lines), "bad measurement line")
        _fails(parse_measurement_lines(lines).select("subject_id"), "bad measurement line")
        rows, left = split_measurement_lines(lines)
        assert [tuple(r) for r in rows.collect()] == [("p0", 1, 2.5)]
        assert [r["value"] for r in left.collect()] == [bad]


def test_short_subject_lines_fail_or_are_returned(spark):
    from cohortmine.sources import parse_subject_lines, split_subject_lines

    lines = spark.createDataFrame([("id,labels,last",), ("a,flu,x",), ("onlyid",)], "value string")
    _fails(parse_subject_lines(lines), "bad subject line")
    rows, left = split_subject_lines(lines)
    assert [tuple(r) for r in rows.collect()] == [("a", "flu", "x")]
    assert [r["value"] for r in left.collect()] == ["onlyid"]


def test_itemset_lines_take_the_field_after_the_first_comma(spark):
    from cohortmine.sources import parse_itemset_lines

    lines = spark.createDataFrame([("5,1;2,7;",), ("",)], "value string")
    assert [tuple(r) for r in parse_itemset_lines(lines).collect()] == [([1, 2], 2, 5)]
    _fails(parse_itemset_lines(spark.createDataFrame([("785",)], "value string")), "bad itemset line")


def test_table_appended_between_reads(spark, scratch):
    from cohortmine.sources import read_table

    spark.range(3).write.parquet(f"{scratch}/part.parquet")
    assert read_table(spark, scratch, "part").count() == 3
    spark.range(5).write.mode("append").parquet(f"{scratch}/part.parquet")
    assert read_table(spark, scratch, "part").count() == 8


def test_level_of_several_files_in_order(spark, scratch):
    rows = [([i, i + 1], 2, 1000 - i % 97) for i in range(400)] + [([i], 1, i) for i in range(50)]
    df = spark.createDataFrame(rows, "items array<int>, k int, cnt long")
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_itemsets_text(df, f"{scratch}/lv", by_level=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    assert len(glob.glob(f"{scratch}/lv/k=2/part-*")) > 1
    want = [f"({c},{';'.join(map(str, x))};)" for c, x in sorted(((c, x) for x, k, c in rows if k == 2), key=lambda t: (-t[0], t[1]))]
    assert _read_parts(f"{scratch}/lv/k=2") == want


def test_csv_and_ragged_subjects_end_to_end(spark, scratch):
    _write(f"{scratch}/measurements.csv", MEAS_CSV)
    _write(f"{scratch}/subjects.txt", SUBJ_TXT)
    meas = read_measurements_csv(spark, f"{scratch}/measurements.csv")
    subj = read_subjects_text(spark, f"{scratch}/subjects.txt")
    assert meas.count() == 6 and subj.count() == 3
    counts = label_counts(subj, meas)
    write_label_counts_text(counts, f"{scratch}/out")
    assert _read_parts(f"{scratch}/out") == ["(leukemia,3)", "(breast-cancer,2)", "(lymphoma,1)"]


def test_subjects_second_to_last_column_any_width(spark, scratch):
    _write(f"{scratch}/s.txt", "id,x,labels,last\na,1,2,3,leukemia,z\nb,leukemia,z\n")
    rows = {r["subject_id"]: r["labels"] for r in read_subjects_text(spark, f"{scratch}/s.txt").collect()}
    assert rows == {"a": "leukemia", "b": "leukemia"}


def test_itemset_lines_both_forms(spark, scratch):
    _write(f"{scratch}/i.txt", "(785,1;2;3;)\n785, 1;2;3\n( 12 , 9; )\n")
    rows = [(list(r["items"]), r["k"], r["cnt"]) for r in read_itemsets_text(spark, f"{scratch}/i.txt").collect()]
    assert rows == [([1, 2, 3], 3, 785), ([1, 2, 3], 3, 785), ([9], 1, 12)]


def test_itemsets_text_round_trip(spark, scratch):
    df = spark.createDataFrame([([1, 2], 2, 5), ([3], 1, 9)], "items array<int>, k int, cnt long")
    write_itemsets_text(df, f"{scratch}/o")
    assert _read_parts(f"{scratch}/o") == ["(9,3;)", "(5,1;2;)"]
    back = read_itemsets_text(spark, f"{scratch}/o")
    assert sorted((tuple(r["items"]), r["cnt"]) for r in back.collect()) == [((1, 2), 5), ((3,), 9)]


def test_rules_and_report_text(spark, scratch):
    rules = spark.createDataFrame([([1], [2, 3], 3.925), ([3], [1, 5], 0.912)],
                                  "antecedent array<int>, consequent array<int>, confidence double")
    write_rules_text(rules, f"{scratch}/r")
    assert _read_parts(f"{scratch}/r") == ["1;\t2;3;\t3.925", "3;\t1;5;\t0.912"]
    rep = spark.createDataFrame([(0.3, [1, 2, 3])], "support double, items array<int>")
    write_support_report_text(rep, f"{scratch}/rep")
    assert _read_parts(f"{scratch}/rep") == ["0.3\t1\t2\t3"]


def test_writer_refuses_existing_folder(spark, scratch):
    df = spark.createDataFrame([("a", 1)], "label string, cnt long")
    write_label_counts_text(df, f"{scratch}/x")
    try:
        write_label_counts_text(df, f"{scratch}/x")
    except Exception as exc:  # errorifexists, as the reference's text sink
        assert "already exists" in str(exc).lower() or "PATH_ALREADY_EXISTS" in str(exc)
    else:
        raise AssertionError("expected the second write to fail")


def test_baskets_text(spark, scratch):
    _write(f"{scratch}/b.txt", "r z h k p\nz y x w v u t s\ns x o n r\n")
    rows = [sorted(r["items"]) for r in read_baskets_text(spark, f"{scratch}/b.txt").collect()]
    assert rows[0] == ["h", "k", "p", "r", "z"] and len(rows) == 3


def test_total_text_length_lines(spark, scratch):
    # The counted-itemset fixture: 3 lines of 10 characters -> 30.
    _write(f"{scratch}/d.txt", "785, 1;2;3\n456, 1;3;5\n132, 2;3;5")
    r = total_text_length(read_lines(spark, f"{scratch}/d.txt")).collect()[0]
    assert (r["total_len"], r["n_lines"]) == (30, 3)


def test_total_text_length_split_column(spark):
    df = spark.createDataFrame([("ab\ncde",), ("",), ("x\n",), (None,)], "text string")
    r = total_text_length(df, "text", split_lines=True).collect()[0]
    # "ab","cde" | "" | "x","" -> lengths 2+3+0+1+0, 5 lines; null rows skipped
    assert (r["total_len"], r["n_lines"]) == (6, 5)


def test_itemsets_text_by_level(spark, scratch):
    df = spark.createDataFrame([([1, 2], 2, 5), ([3], 1, 9), ([4], 1, 11)],
                               "items array<int>, k int, cnt long")
    write_itemsets_text(df, f"{scratch}/lv", by_level=True, size1_trailing=False)
    assert _read_parts(f"{scratch}/lv/k=1") == ["(11,4)", "(9,3)"]
    assert _read_parts(f"{scratch}/lv/k=2") == ["(5,1;2;)"]


def test_subjects_empty_last_column_keeps_position(spark, scratch):
    # The field before the (empty) last one is still the label field.
    _write(f"{scratch}/s.txt", "id,labels,last\na,leukemia,\nb,lymphoma,x\n")
    rows = {r["subject_id"]: (r["labels"], r["last"])
            for r in read_subjects_text(spark, f"{scratch}/s.txt").collect()}
    assert rows == {"a": ("leukemia", ""), "b": ("lymphoma", "x")}


def test_fp_growth_on_basket_file(spark, scratch):
    import itertools

    from cohortmine import fp_itemsets, fp_rules

    lines = ["r z h k p", "z y x w v u t s", "s x o n r", "x z y m t s q e", "z", "x z y r q t p"]
    _write(f"{scratch}/fp.txt", "\n".join(lines) + "\n")
    bask = read_baskets_text(spark, f"{scratch}/fp.txt")
    got = {tuple(r["items"]): r["cnt"] for r in fp_itemsets(bask, 0.5, strict=False).collect()}
    sets = [set(ln.split()) for ln in lines]
    items = sorted(set().union(*sets))
    want = {}
    for k in range(1, len(items) + 1):
        for combo in itertools.combinations(items, k):
            c = sum(1 for b in sets if set(combo) <= b)
            if c >= 3:  # inclusive bound: freq >= ceil(0.5 * 6)
                want[combo] = c
    assert got == want
    rules = fp_rules(bask, 0.5, 0.8).collect()
    for r in rules:
        whole = tuple(sorted(list(r["antecedent"]) + list(r["consequent"])))
        assert len(r["consequent"]) == 1
        assert abs(r["confidence"] - want[whole] / want[tuple(r["antecedent"])]) < 1e-12
        assert r["confidence"] >= 0.8


def test_itemsets_parquet_round_trip(spark, scratch):
    from cohortmine.sources.text_io import write_itemsets_parquet

    df = spark.createDataFrame([([1, 2], 2, 5), ([3], 1, 9)], "items array<int>, k int, cnt long")
    write_itemsets_parquet(df, f"{scratch}/pq")
    back = spark.read.parquet(f"{scratch}/pq")
    assert sorted((tuple(r["items"]), r["k"], r["cnt"]) for r in back.collect()) == [((1, 2), 2, 5), ((3,), 1, 9)]
    assert sorted(p.split("=")[1] for p in __import__("os").listdir(f"{scratch}/pq") if "=" in p) == ["1", "2"]

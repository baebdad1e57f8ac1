"""The line formats as a registered data source."""

import glob
import gzip
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from cohortmine.sources import line_format as lf
from cohortmine.sources.text_io import (
    itemset_lines,
    label_count_lines,
    parse_basket_lines,
    parse_itemset_lines,
    parse_measurement_lines,
    parse_subject_lines,
    report_lines,
    rule_lines,
)

NUMBERS = ["1", "-7", "+3", " 42 ", "2147483647", "-2147483648", "007", "-000000000000000012"]
VALUES = ["1300000", "1250000.5", "-0.25", "1e6", "1E-3", ".5", "5.", "NaN", "Infinity", "-Infinity", " 2.5 "]


def _put(folder, name, data):
    with open(f"{folder}/{name}", "wb") as fh:
        fh.write(data)


def _rows(df):
    def plain(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else tuple(v) if isinstance(v, list) else v
    return sorted((tuple(map(plain, r)) for r in df.collect()), key=repr)


def _read(spark, path, kind, **options):
    return spark.read.format(lf.register(spark)).options(kind=kind, **options).load(path)


def _lines(kind, seed=3, n=400):
    rnd = random.Random(seed)
    if kind == "measurements":
        return ["patientid,geneid,v"] + [
            f"pé{rnd.randrange(40)},{rnd.choice(NUMBERS)},{rnd.choice(VALUES)}{rnd.choice(['', ',more', ','])}" for _ in range(n)] + ["patientid"]
    if kind == "subjects":
        return ["id,labels,last"] + [
            f"s{i}," + ",".join(rnd.choice(["", "x", "a b", "leukemia lymphoma"]) for _ in range(rnd.randrange(1, 5))) for i in range(n)]
    if kind == "itemsets":
        return ["", "  "] + [rnd.choice(["({},{})", "{}, {}", " ( {} , {} ) ,9;"]).format(
            rnd.randrange(99), rnd.choice([";".join(map(str, rnd.sample(range(50), 3))) + ";", "4", "9;4", "3;3;", ""])) for _ in range(n)]
    return ["", " "] + [" ".join(rnd.choice(["a", "b", "", "cc", "d"]) for _ in range(rnd.randrange(1, 9))) for _ in range(n)]


PARSE = {"measurements": parse_measurement_lines, "subjects": parse_subject_lines,
         "itemsets": parse_itemset_lines, "baskets": parse_basket_lines}


@pytest.mark.parametrize("kind", sorted(PARSE))
@pytest.mark.parametrize("sizes", [(64 << 20, 4 << 20), (37, 11), (1000, 64), (1, 1)])
def test_reads_what_the_parse_functions_read(spark, scratch, kind, sizes):
    lines = _lines(kind, n=60 if sizes[0] == 1 else 400)
    if sizes[0] == 1:
        lines = lines[:8]  # a task a byte
    _put(scratch, "a.txt", "\n".join(lines[:len(lines) // 2]).encode() + b"\n")
    _put(scratch, "b.txt", "\r\n".join(lines[len(lines) // 2:]).encode())  # no last line end
    _put(scratch, "_hidden", b"junk")
    _put(scratch, "empty.txt", b"")
    got = _read(spark, scratch, kind, splitBytes=sizes[0], blockBytes=sizes[1])
    want = PARSE[kind](spark.read.text(scratch))
    assert got.schema == want.schema or got.dtypes == want.dtypes
    assert _rows(got) == _rows(want)


def test_every_split_gives_each_line_once(scratch):
    lines = [b"x" * (i % 7) + str(i).encode() for i in range(60)]
    for end in (b"", b"\n", b"\n\n"):
        data = b"\n".join(lines) + end
        _put(scratch, "f", data)
        whole = data.split(b"\n")
        whole = whole[:-1] if not whole[-1] else whole
        for split in range(1, len(data) + 2, 3):
            for block in (1, 5, 4096):
                got = [ln for lo in range(0, len(data), split)
                       for b in lf._blocks(lf.LineRange(f"{scratch}/f", lo, min(lo + split, len(data))), block)
                       for ln in (b[:-1] if b.endswith(b"\n") else b).split(b"\n")]
                assert got == whole, (split, block)


def test_files_globs_lists_compression(spark, scratch):
    os.mkdir(f"{scratch}/sub")
    _put(scratch, "a.txt", b"x y\n")
    _put(scratch, "b.log", b"z\n")
    with gzip.open(f"{scratch}/sub/c.gz", "wb") as fh:
        fh.write(b"q r\n" * 3)
    items = lambda p: _rows(_read(spark, p, "baskets", splitBytes=2))
    assert items(scratch) == [(("x", "y"),), (("z",),)]
    assert items(f"{scratch}/*.txt") == [(("x", "y"),)]
    assert items(f"{scratch}/b.log,{scratch}/sub") == [(("q", "r"),)] * 3 + [(("z",),)]
    assert items(f"file://{scratch}/b.log") == [(("z",),)]
    with pytest.raises(Exception, match="FileNotFound"):
        items(f"{scratch}/none")


def test_modes_for_bad_lines(spark, scratch):
    bad = ["p1,x,3", "p2,1", "p3,1,abc", "p4,99999999999,1", "p4,2147483648,1", "p5,-,1", "only", ""]
    _put(scratch, "m.txt", "\n".join(["p0,1,2.5", *bad, "p9,2,1"]).encode())
    with pytest.raises(Exception, match="bad measurements line: p1,x,3"):
        _read(spark, scratch, "measurements").collect()
    good = [("p0", 1, 2.5), ("p9", 2, 1.0)]
    assert _rows(_read(spark, scratch, "measurements", mode="dropmalformed")) == good
    both = _read(spark, scratch, "measurements", mode="permissive")
    assert both.columns == ["subject_id", "feature_id", "value", "bad_line"]
    assert sorted(r.bad_line for r in both.filter("bad_line is not null").collect()) == sorted(bad)
    assert _rows(both.filter("bad_line is null").drop("bad_line")) == good
    cases = (("itemsets", "(x,1;)"), ("itemsets", "5"), ("itemsets", "(5,a;)"), ("subjects", "alone"))
    for i, (kind, line) in enumerate(cases):
        folder = f"{scratch}/bad{i}"
        os.mkdir(folder)
        _put(folder, "f", line.encode())
        with pytest.raises(Exception, match=f"bad {kind} line"):
            _read(spark, folder, kind).collect()


def test_options_are_checked(spark, scratch):
    _put(scratch, "m.txt", b"p0,1,2.5\n")
    fmt = spark.read.format(lf.register(spark))
    for options in ({}, {"kind": "rules"}, {"kind": "baskets", "mode": "guess"}):
        with pytest.raises(Exception, match="cohort_lines"):
            spark.read.format(lf.NAME).options(**options).load(scratch).collect()
    some = fmt.option("kind", "measurements").schema("value double, subject_id string").load(scratch)
    assert [tuple(r) for r in some.collect()] == [(2.5, "p0")]
    with pytest.raises(Exception, match="not of this kind"):
        fmt.option("kind", "measurements").schema("value string").load(scratch).collect()


def test_written_lines_equal_the_formatters(spark, scratch):
    sets = spark.createDataFrame([([1, 2], 2, 9), ([3], 1, 4)], "items array<int>, k int, cnt long")
    counts = spark.createDataFrame([("leukemia", 3), ("lymphoma", 1)], "label string, cnt long")
    report = spark.createDataFrame([(0.5, [1, 2]), (0.0001, [7])], "support double, items array<int>")
    rules = spark.createDataFrame([([1], [2, 3], 0.75), ([4], [5], 1.0)],
                                  "antecedent array<int>, consequent array<int>, confidence double")
    for kind, df, lines in (("itemsets", sets, itemset_lines), ("label_counts", counts, label_count_lines),
                            ("report", report, report_lines), ("rules", rules, rule_lines)):
        df.write.format(lf.register(spark)).option("kind", kind).mode("append").save(f"{scratch}/{kind}")
        got = sorted(r.value for r in spark.read.text(f"{scratch}/{kind}").collect())
        assert got == sorted(r.value for r in lines(df).collect())


def test_append_overwrite_commit_and_abort(spark, scratch):
    path = f"{scratch}/out"
    rows = [("p1", 1, 1.5), ("p2", 2, float("nan")), ("p3", 3, 1.25e10), ("p4", 4, -1e-7), ("p5", 5, 12345678.25)]
    df = spark.createDataFrame(rows, "subject_id string, feature_id int, value double").repartition(3)
    save = lambda d, mode: d.write.format(lf.register(spark)).option("kind", "measurements").mode(mode).save(path)
    save(df, "append")
    once = _rows(df)
    assert _rows(_read(spark, path, "measurements")) == once
    assert os.path.exists(f"{path}/_SUCCESS") and not glob.glob(f"{path}/_temporary*")
    save(df, "append")
    assert len(_rows(_read(spark, path, "measurements"))) == 2 * len(once)
    save(df, "overwrite")
    assert _rows(_read(spark, path, "measurements")) == once
    before = sorted(os.listdir(path))
    broken = df.withColumn("value", F.when(F.col("feature_id") == 3, F.raise_error("no").cast("double")).otherwise(F.col("value")))
    with pytest.raises(Exception):
        save(broken, "append")
    assert sorted(os.listdir(path)) == before  # nothing of the failed write is left
    with pytest.raises(Exception, match="line end"):
        save(df.withColumn("subject_id", F.lit("a\nb")), "append")
    with pytest.raises(Exception, match="need the columns"):
        save(df.drop("value"), "append")
    assert sorted(os.listdir(path)) == before
    text = spark.read.text(path).collect()
    assert {"p3,3,1.25E10", "p4,4,-1.0E-7", "p5,5,1.234567825E7"} <= {r.value for r in text}

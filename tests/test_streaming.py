"""Streaming label profile equals the batch one over the same files."""

from cohortmine import label_counts
from cohortmine.streaming import label_counts_stream, start_label_counts


def test_stream_equals_batch(spark, scratch):
    rows = [("p1", 42, 1300000.0), ("p2", 42, 1250000.5), ("p2", 42, 2000000.0),
            ("p4", 42, 1400000.0), ("p1", 7, 1250000.0)]
    for i, chunk in enumerate([rows[:2], rows[2:]]):
        (spark.createDataFrame(chunk, "subject_id string, feature_id int, value double")
         .coalesce(1).write.parquet(f"{scratch}/in/part{i}"))
    subj = spark.createDataFrame(
        [("p1", "leukemia lymphoma", "1"), ("p2", "  breast-cancer  leukemia ", "2")],
        "subject_id string, labels string, last string")
    stream = label_counts_stream(spark, f"{scratch}/in/*", subj)
    q = start_label_counts(stream, "label_counts_test", available_now=True,
                           checkpoint_location=f"{scratch}/ckpt")
    q.awaitTermination(120)
    got = {r["label"]: r["cnt"] for r in spark.sql("SELECT * FROM label_counts_test").collect()}
    meas = spark.read.parquet(f"{scratch}/in/*")
    want = {r["label"]: r["cnt"] for r in label_counts(subj, meas).collect()}
    assert got == want == {"leukemia": 3, "breast-cancer": 2, "lymphoma": 1}


def test_stream_over_csv_files(spark, scratch):
    import os

    os.makedirs(f"{scratch}/csv")
    with open(f"{scratch}/csv/a.csv", "w") as fh:
        fh.write("patientid,geneid,expression_value\np1,42,1300000\np2,42,2000000\n")
    with open(f"{scratch}/csv/b.csv", "w") as fh:
        fh.write("patientid,geneid,expression_value\np2,42,1250000.5\np1,7,1300000\n")
    subj = spark.createDataFrame(
        [("p1", "leukemia lymphoma", "1"), ("p2", "  breast-cancer  leukemia ", "2")],
        "subject_id string, labels string, last string")
    stream = label_counts_stream(spark, f"{scratch}/csv", subj, fmt="csv", max_files_per_trigger=1)
    q = start_label_counts(stream, "label_counts_csv", available_now=True,
                           checkpoint_location=f"{scratch}/ckpt_csv")
    q.awaitTermination(120)
    got = {r["label"]: r["cnt"] for r in spark.sql("SELECT * FROM label_counts_csv").collect()}
    assert got == {"leukemia": 3, "breast-cancer": 2, "lymphoma": 1}

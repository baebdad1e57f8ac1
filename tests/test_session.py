"""Checkpoint folder resolution."""

from cohortmine.session import ensure_checkpoint_dir


def test_keeps_existing_checkpoint_dir(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert before
    assert ensure_checkpoint_dir(spark) == before


def test_checkpoint_is_reliable(spark):
    df = spark.range(10).checkpoint()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" in plan and df.count() == 10

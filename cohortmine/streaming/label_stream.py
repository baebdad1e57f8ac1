"""Label profile over a stream of measurement files.

The reference runs its jobs in batch only; this module offers the same H1 result
when measurement files keep arriving in a folder: a file-source stream, a
stream-static join with the (static) subject labels and a running count per label.
The aggregation state is one row per label, so no watermark is needed; the result
is maintained in ``complete`` mode and equals the batch :func:`label_counts` over
all files processed so far.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortmine.operators.cohort import explode_labels, strong_measurements
from cohortmine.schemas import DEFAULT_FEATURE, DEFAULT_LABELS, DEFAULT_MIN_VALUE, MEASUREMENT
from cohortmine.session import ensure_checkpoint_dir
from cohortmine.sources.text_io import parse_measurement_lines


def label_counts_stream(spark: SparkSession, source_dir: str, subjects: DataFrame,
                        labels: Iterable[str] | None = DEFAULT_LABELS,
                        feature: int | None = DEFAULT_FEATURE,
                        min_value: float = DEFAULT_MIN_VALUE, fmt: str = "parquet",
                        schema=MEASUREMENT, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame ``(label, cnt)`` over measurement files in ``source_dir``."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        rows = parse_measurement_lines(reader.text(source_dir))
    else:
        rows = reader.format(fmt).schema(schema).load(source_dir)
    meas = strong_measurements(rows, feature, min_value)
    lab = explode_labels(subjects, labels)
    return (meas.join(lab, "subject_id")
            .groupBy("label").agg(F.count(F.lit(1)).cast("long").alias("cnt")))


def start_label_counts(stream: DataFrame, query_name: str, sink: str = "memory",
                       path: str | None = None, checkpoint_location: str | None = None,
                       available_now: bool = False) -> StreamingQuery:
    """Start the stream in ``complete`` mode.

    The streaming checkpoint goes under the cluster's ``spark.checkpoint.dir`` unless
    given, so the query restarts from its offsets after a failure.
    """
    spark = stream.sparkSession
    if checkpoint_location is None:
        base = ensure_checkpoint_dir(spark)
        checkpoint_location = os.path.join(base, "streams", query_name)
    writer = (stream.writeStream.outputMode("complete").queryName(query_name)
              .option("checkpointLocation", checkpoint_location))
    if sink == "memory":
        writer = writer.format("memory")
    else:
        if path is None:
            raise ValueError("a path is needed for a file sink")

        def write_batch(batch: DataFrame, _epoch: int) -> None:
            batch.write.mode("overwrite").format(sink).save(path)

        writer = writer.foreachBatch(write_batch)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()

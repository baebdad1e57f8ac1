"""Frequent itemsets over a stream of transaction or measurement files (H4).

Each micro-batch goes through :func:`cohortmine.operators.border.update_itemsets`: the state is a
folder of Parquet tables keyed by itemset and transaction, a version a batch. Batch ids come from
the query's checkpoint, so a batch repeated after a failure replaces its own version.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cohortmine.operators.border import update_itemsets
from cohortmine.schemas import DEFAULT_MIN_SUPPORT
from cohortmine.session import ensure_checkpoint_dir


def start_itemsets(stream: DataFrame, state: str, query_name: str, min_support: float = DEFAULT_MIN_SUPPORT,
                   max_size: int | None = None, whole: bool = False,
                   prepare: Callable[[DataFrame], DataFrame] | None = None,
                   checkpoint_location: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Start the stream; :func:`cohortmine.operators.border.stored_itemsets` reads its result.

    ``stream`` holds (tid, item) rows, or whatever ``prepare`` turns into them batch by batch (a
    cohort join over measurements, say). ``state`` names a shared folder.
    """
    spark = stream.sparkSession
    if checkpoint_location is None:
        checkpoint_location = os.path.join(ensure_checkpoint_dir(spark), "streams", query_name)

    def take(batch: DataFrame, batch_id: int) -> None:
        update_itemsets(state, prepare(batch) if prepare else batch, batch_id, min_support, max_size, whole)

    writer = (stream.writeStream.queryName(query_name).option("checkpointLocation", checkpoint_location)
              .foreachBatch(take))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()

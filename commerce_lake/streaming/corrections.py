"""Late corrections as a stream.

The curated tables are kept by keyed upserts; a stream of corrections (a
delivery that arrives or is fixed days later) needs nothing more than
applying each micro-batch as one upsert.  ``foreachBatch`` hands every batch
to ``ChangeLog.upsert``: a replayed batch (after a restart from the
checkpoint) finds identical current rows and appends nothing, so the sink is
idempotent.  Within a batch, the newest row per key wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from commerce_lake.operators.latest import latest_by
from commerce_lake.operators.upsert import ChangeLog


def apply_corrections(spark: SparkSession, stream: DataFrame, table_path: str, keys: Sequence[str],
                      order_col: str, checkpoint: str, partition_by: Sequence[str] | None = None,
                      trigger_once: bool = True):
    """Start a streaming query that upserts every micro-batch into the
    change log at ``table_path``.  Returns the StreamingQuery."""
    log = ChangeLog(spark, table_path, keys, partition_by)

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        newest = latest_by(batch, list(keys), order_col, ingested_col="_none_")
        if newest.take(1):
            log.upsert(newest, operation=f"STREAM_BATCH_{batch_id}", check_unique=False)

    w = stream.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="10 seconds")
    return w.start()

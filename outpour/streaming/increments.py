"""Deliver what arrives in a source, instead of polling it by ``updated_at``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from outpour.contracts import Context
from outpour.operators.deliver import Send, attempt, record

BATCH_COLUMN = "stream_batch"
RUN_COLUMN = "stream_run"


def run_stream(
    rows: DataFrame,
    context: Context,
    sender_factory: Callable[[], Send],
    results_path: str,
    checkpoint_path: str,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Start delivering a streaming frame; results go to ``results_path`` as Parquet.

    Each micro-batch writes the folder ``stream_run=<query>/stream_batch=<id>`` and replaces it if it
    is run again after a failure, so a row has one result even when it was sent twice. The query's
    id belongs to its checkpoint: a new checkpoint, whose batches count from 0 again, and other
    streams into the same path never touch these results. ``trigger`` takes the
    arguments of ``DataStreamWriter.trigger``; by default everything that is there is delivered
    and the query ends. ``options`` are those of ``deliver``.
    """

    def deliver_batch(batch: DataFrame, batch_id: int) -> None:
        attempted = attempt(batch, context, sender_factory, **options)
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = f"{results_path.rstrip('/')}/{RUN_COLUMN}={query}/{BATCH_COLUMN}={batch_id}"
        recorded = record(attempted, lambda rows: rows.write.mode("overwrite").parquet(folder))
        if recorded.stop is not None:
            # Its text reaches the query's exception, where ``send_error`` finds the response.
            raise RuntimeError(recorded.stop)

    return (
        rows.writeStream.foreachBatch(deliver_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )

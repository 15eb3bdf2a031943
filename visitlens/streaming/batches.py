"""Start a stream whose micro-batches are handled with their query's id."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start_batches(rows: DataFrame, handle: Callable[[DataFrame, str, int], None], checkpoint: str, mode: str = "append",
                  available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """``handle(batch, run, batch_id)`` for every micro-batch; ``run`` is the
    query's id, which a restart from the same checkpoint keeps."""
    run: Future[str] = Future()

    def batch(df: DataFrame, batch_id: int) -> None:
        handle(df, run.result(timeout=300), batch_id)

    writer = rows.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    query = writer.start()
    run.set_result(query.id)
    return query

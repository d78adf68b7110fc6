"""Run a stream of lines through a put function."""

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Batch interval and time limits of the streaming jobs.
DEFAULT_INTERVAL = "500 milliseconds"
NODE_TIMEOUT_SECONDS = 12_000
EXPLORER_TIMEOUT_SECONDS = 15_000
PREVIEW_TIMEOUT_SECONDS = 13_000
PREVIEW_ROWS = 200


def _await_idle(query: StreamingQuery, timeout: float | None) -> None:
    """Wait until all that is there is worked off, or the time is up."""
    end = None if timeout is None else time.monotonic() + timeout
    while end is None or time.monotonic() < end:
        if query.awaitTermination(0.2):
            return
        progress, status = query.lastProgress, query.status
        waiting = not status["isDataAvailable"] and not status["isTriggerActive"]
        if waiting and progress is not None and progress["numInputRows"] == 0:
            return


def _finish(writer, interval: str | None, timeout: float | None, until_idle: bool = False) -> None:
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    query = writer.trigger(**trigger).start()
    try:
        if until_idle and interval:
            _await_idle(query, timeout)
        elif timeout is None:
            query.awaitTermination()
        else:
            query.awaitTermination(timeout)
    finally:
        query.stop()


def run_stream(
    lines: DataFrame,
    put: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = DEFAULT_INTERVAL,
    timeout: float | None = None,
    until_idle: bool = False,
) -> None:
    """Call ``put(batch, batch_id)`` for every micro-batch of ``lines``.

    Runs until stopped or until ``timeout`` seconds have passed, and with ``until_idle``
    until an interval brings nothing new. Without an interval it works off what is there, in micro-batches, and returns. The
    batch is an ordinary DataFrame, planned adaptively; after a failure the same
    lines come again under the same ``batch_id``.
    """
    writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put)
    _finish(writer, interval, timeout, until_idle)


def preview_batches(
    rows: DataFrame,
    show: Callable[[DataFrame, int], None],
    count: int = PREVIEW_ROWS,
    interval: str | None = DEFAULT_INTERVAL,
    timeout: float | None = PREVIEW_TIMEOUT_SECONDS,
    until_idle: bool = False,
) -> None:
    """Hand the first rows of every micro-batch to ``show(rows, batch_id)``."""
    writer = rows.writeStream.foreachBatch(lambda batch, batch_id: show(batch.limit(count), batch_id))
    _finish(writer, interval, timeout, until_idle)


def preview_stream(
    rows: DataFrame,
    count: int = PREVIEW_ROWS,
    interval: str | None = DEFAULT_INTERVAL,
    timeout: float | None = PREVIEW_TIMEOUT_SECONDS,
) -> None:
    """Print the first rows of every micro-batch."""
    writer = (
        rows.writeStream.format("console")
        .outputMode("append")
        .option("numRows", count)
        .option("truncate", False)
    )
    _finish(writer, interval, timeout)

"""Event-time streams: repeated and late events by a watermark and the state store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def first_events(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """The first arrival of each key; events that come later than ``delay`` are left out.

    The watermark is the largest event time of earlier micro-batches less the delay.  A key
    stays in the state store until the watermark has passed its time by the delay, so state
    is bounded by the events of such a span, not by the history.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all that has come to Parquet, exactly once, and stop.

    The checkpoint holds the files that are done, the watermark and the state; a stream
    that starts again with it goes on where the last one ended.
    """
    writer = stream.writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def late_rows(query: StreamingQuery) -> int:
    """How many rows of an ended stream came too late."""
    return sum(
        state.numRowsDroppedByWatermark for progress in query.recentProgress for state in progress.stateOperators
    )

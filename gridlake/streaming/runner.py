"""Starting streams: service mode runs on a timer, chained runs take what is there and stop."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# Fixed value: the feed is polled every 300 seconds.
SERVICE = {"processingTime": "300 seconds"}
CHAINED = {"availableNow": True}


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark kept out of a stream's state, in the batches whose progress the query still holds.

    :class:`gridlake.streaming.late.DroppedRows` keeps the numbers of all batches.
    """
    states = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    return sum(state["numRowsDroppedByWatermark"] for state in states)


def start(writer: DataStreamWriter, checkpoint: str, trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Start a stream on its checkpoint. A chained run (the default) is waited for and fails with its query."""
    chosen = dict(trigger or CHAINED)
    running = writer.option("checkpointLocation", checkpoint).trigger(**chosen).start()
    if chosen.get("availableNow"):
        running.awaitTermination()
    return running

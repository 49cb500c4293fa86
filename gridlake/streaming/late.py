"""Rows that come too late, kept and counted.

Operators with a watermark drop what lies behind it. :func:`split_late` stands before them: what is behind the newest time
of earlier batches by more than the delay goes to a table of its own, and the rest to the stream's own table, which such
an operator then follows. :class:`DroppedRows` writes down, batch by batch, how many rows operators dropped nonetheless.
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from contextlib import ExitStack
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
)

from gridlake.operators.gold import staged
from gridlake.session import discard
from gridlake.sources.sinks import Writer, batch_key
from gridlake.streaming.runner import start


def split_late(
    stream: DataFrame,
    ts: str,
    delay: str,
    on_time: Writer,
    late: Writer,
    marks: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Give a batch's rows to ``on_time``, or to ``late`` if their ``ts`` is before the high-water mark by over ``delay``.

    The mark of a batch is the newest ``ts`` of all batches before it. It is kept under ``marks`` by query and batch: a
    stream that starts again goes on from it, and a replayed batch splits as it did before. Rows without a time are on
    time. Writers that replace what they wrote for the same batch make a replay harmless.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _mark(spark, marks, batch_key(batch, batch_id - 1)) if batch_id else None
        with ExitStack() as stack:
            # Read three times, once for its newest time.
            rows = staged(spark, batch, stack)
            behind = F.lit(False)
            if before is not None:
                kind = rows.schema[ts].dataType
                bound = (F.lit(before).cast(kind) - F.expr(f"INTERVAL {delay}")).cast(kind)
                behind = F.coalesce(F.col(ts) < bound, F.lit(False))
            late(rows.where(behind), batch_id)
            on_time(rows.where(~behind), batch_id)
            newest = rows.agg(F.max(F.col(ts).cast("timestamp")).alias("mark"))
            mark = newest.select(F.greatest("mark", F.lit(before).cast("timestamp")).alias("mark"))
            mark.coalesce(1).write.mode("overwrite").parquet(f"{marks}/{batch_key(batch, batch_id)}")
        if batch_id > 1:
            discard(spark, f"{marks}/{batch_key(batch, batch_id - 2)}")

    return start(stream.writeStream.foreachBatch(write), checkpoint, trigger)


def _mark(spark: SparkSession, marks: str, key: str) -> datetime | None:
    """A batch without its mark is an error, not a stream without late rows."""
    return spark.read.schema("mark timestamp").parquet(f"{marks}/{key}").first()["mark"]


class DroppedRows(StreamingQueryListener):
    """Writes to ``folder``, for every batch of every stream of the session, the rows that watermarks kept out.

    Unlike a query's own progress, which holds the last hundred batches of one run, the numbers stay, and add up across
    restarts. A batch that runs again replaces its number. Add it with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.seen: dict[str, int] = {}

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        progress = event.progress
        query, batch = str(progress.id), int(progress.batchId)
        dropped = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        row = self.spark.createDataFrame([(query, batch, dropped)], DROPPED)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{query}-{batch}")
        self.seen[query] = max(batch, self.seen.get(query, -1))

    def wait_for(self, query: StreamingQuery, seconds: float = 30.0) -> None:
        """Wait until the last batch of ``query`` is written down; events come behind the batches."""
        last = query.lastProgress
        until = time.monotonic() + seconds
        while last and self.seen.get(str(query.id), -1) < last["batchId"] and time.monotonic() < until:
            time.sleep(0.05)


DROPPED = "query string, batch bigint, dropped bigint"


def dropped_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``query, batch, dropped`` as :class:`DroppedRows` wrote them."""
    return spark.read.schema(DROPPED).option("recursiveFileLookup", True).parquet(folder)

"""Change detection on a payload stream, with the last checksum of every feed kept across restarts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridlake.operators.feed import with_checksum
from gridlake.operators.gold import staged
from gridlake.operators.ordered import previous
from gridlake.operators.silver import dedupe
from gridlake.sources.readers import picked_rows, placed_lines
from gridlake.sources.sinks import Writer, batch_key, publish
from gridlake.streaming.runner import start


def changed_payloads_stream(
    stream: DataFrame,
    feed: Sequence[str],
    arrival: str,
    content: str,
    width: str | int,
    output: str,
    state: str,
    checkpoint: str,
    ties: Sequence[str] = (),
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Write payloads that differ from the one before them to ``output/batch_id=...``.

    Every batch is scanned like a table, cut along the arrival axis, so a feed with most of the payloads does not land
    in one task and payloads never pass through Python. The last checksum per feed goes to one of two folders by turns:
    batch ``n`` reads the folder of ``n - 1`` and replaces the other, and a replayed batch finds what it found before.
    """
    key = [*feed, arrival, *ties]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = with_checksum(batch, content, "__crc").withColumn("__known", F.lit(False))
        if batch_id:
            known = spark.read.parquet(f"{state}/{(batch_id - 1) % 2}").withColumn("__known", F.lit(True))
            rows = rows.unionByName(known, allowMissingColumns=True)
        with ExitStack() as stack:
            # Read for its changes, for its last checksums and to find the width of the scan's buckets.
            rows = staged(spark, rows, stack)
            marked = previous(rows, feed, arrival, {"__before": "__crc"}, width, ties)
            changed = marked.where(~F.col("__known") & ~F.col("__crc").eqNullSafe(F.col("__before")))
            target = f"{output}/batch_id={batch_key(batch, batch_id)}"
            changed.select(*batch.columns).write.mode("overwrite").parquet(target)
            last = dedupe(rows.select(*key, "__crc"), feed, [arrival, *ties])
            last.write.mode("overwrite").parquet(f"{state}/{batch_id % 2}")

    return start(stream.writeStream.foreachBatch(write), checkpoint, trigger)


def run_feed(
    spark: SparkSession,
    path: str,
    columns: T.StructType,
    writer: Writer,
    checkpoint: str,
    delimiter: str = ",",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Give the records of newly landed CSV documents (:func:`gridlake.sources.readers.landing_feed`) to ``writer``.

    Documents may be of any size: a batch holds whole files, whose blocks are read by different tasks.
    """
    lines = placed_lines(spark.readStream.format("text").option("lineSep", "\n").load(path))

    def write(batch: DataFrame, batch_id: int) -> None:
        writer(picked_rows(batch, columns, delimiter), batch_id)

    return start(lines.writeStream.foreachBatch(write), checkpoint, trigger)


def topic_writer(
    encode: Callable[[DataFrame], DataFrame], fmt: str = "kafka", path: str | None = None, **options: str
) -> Writer:
    """Publish each batch as messages. Text folders are per batch, and a replay replaces its own; a broker gets at least
    once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch_id={batch_key(batch, batch_id)}" if path else None
        publish(encode(batch), fmt, target, mode="overwrite", **options)

    return write


def publish_stream(
    messages: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    path: str | None = None,
    trigger: Mapping[str, object] | None = None,
    **options: str,
) -> StreamingQuery:
    """Send a stream of encoded messages to a topic (at least once) or to text files that stand for one.

    Each batch reports the number of messages ``sent`` among its observed metrics.
    """
    counted = messages.observe("published", F.count(F.lit(1)).alias("sent"))
    out = counted.select("value") if fmt == "text" else counted
    writer = out.writeStream.format(fmt).outputMode("append").options(**options)
    return start(writer.option("path", path) if path else writer, checkpoint, trigger)

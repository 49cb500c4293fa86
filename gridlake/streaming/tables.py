"""De-duplication on a stream and streaming upserts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import ExitStack

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridlake.operators.gold import staged, touched, upsert_table
from gridlake.operators.silver import dedupe
from gridlake.sources.sinks import batch_key, ensure_table, overwrite_table
from gridlake.streaming.runner import start


def dedupe_stream(
    stream: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 hour", salts: int = 8
) -> DataFrame:
    """First arrival per key among rows whose times lie within ``delay`` of each other.

    Rows later than the watermark are dropped even when their key is new (:func:`gridlake.streaming.runner.late_rows`
    counts them), and which of the rows of one batch stays is not fixed. :func:`first_arrivals_stream` has neither limit.
    Copies are first dropped per key and input task group (``salts``), so a key with
    very many copies is spread over several tasks and reaches the second step at most ``salts`` times.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    if salts > 1:
        salted = timed.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        timed = salted.dropDuplicatesWithinWatermark([*keys, "__salt"]).drop("__salt")
    return timed.dropDuplicatesWithinWatermark(list(keys))


def first_arrivals_stream(
    stream: DataFrame,
    table: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    checkpoint: str,
    partition_by: Sequence[str],
    fmt: str = "parquet",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Append to ``table`` the first row by ``order_by`` of every key that the table does not hold yet.

    The table is the state, so no row is ever too late and nothing expires; a batch reads the partitions it names.
    Within a batch each task sends one row per key. Each batch adds partitions of its own (``batch``), which a replay
    replaces; the partition must be a function of the key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = batch_key(batch, batch_id)
        first = dedupe(batch, keys, order_by, "first").withColumn("batch", F.lit(name))
        ensure_table(spark, table, first.schema, [*partition_by, "batch"], fmt)
        with ExitStack() as stack:
            rows = staged(spark, first, stack)
            known = touched(spark.table(table), rows, partition_by).where(F.col("batch") != name)
            new = rows.join(known.select(*keys), list(keys), "left_anti")
            overwrite_table(new.hint("rebalance", *[F.col(c) for c in partition_by]), table, "dynamic")

    return start(stream.writeStream.foreachBatch(write), checkpoint, trigger)


def upsert_stream(
    stream: DataFrame,
    table: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    checkpoint: str,
    partition_by: Sequence[str] = (),
    key_moves: bool = False,
    fmt: str = "parquet",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Upsert every batch into ``table``; within a batch the last row by ``order_by`` wins. Replays change nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch.sparkSession, table, batch, keys, partition_by, "latest", order_by, key_moves, fmt)

    return start(stream.writeStream.foreachBatch(write), checkpoint, trigger)
